"""Line deduplication: a suffix array over line sequences by distributed prefix doubling.

Positions are the non-blank lines of all documents, numbered in (doc, line) order.

* Prefix doubling with discarding: round k ranks the windows of 2^k lines that occur more
  than once.  A window of the next round is the pair of its halves' ranks; pairs are
  counted (partial aggregation), the repeated ones sorted and numbered in order.  Positions
  whose window is unique have their final place in the suffix order and drop out, so every
  round handles repeated text only.  The ranks of all rounds are the buckets of the suffix
  array for prefixes of 1, 2, 4, ... lines.
* LCP intervals: a bucket of round k and its sub-buckets of round k + 1 differ somewhere
  between 2^k and 2^(k+1) lines.  Halving that span, with one representative (the first
  position) per sub-bucket, yields every interval of suffixes with a common prefix of
  exactly l lines.  In an interval, every sub-interval but the one with the first position
  repeats text from an earlier place: its first position has a longest previous match of
  exactly l lines.  Each position gets its match in exactly one interval.
* Deletion: a maximal run of at least ``min_words`` words that matches an earlier place is a
  later copy; the lines that such runs cover go, the first copy stays.

Every shuffle is keyed by position or by (bucket, rank); buckets that hold much of the
table (a line in a third of all documents) are met through ``join_weighted``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkpanel.llm.common import join_weighted, let, materialise

BLANK = "[ \\t-\\r]"


def line_positions(docs: DataFrame, text: str, doc: str) -> DataFrame:
    """Written table: pos, stop (position after the document's last line), doc, text_hash, ln
    (line number), h1, h2 (128-bit line identity), w (words), before (words in earlier lines).

    Rows with the same doc and text are one document.  Lines compare trimmed of white space
    at their ends; blank lines are no positions.
    """
    lines = F.transform(F.split(F.col(text), "\n"), lambda x, i: F.struct(
        F.btrim(x, F.lit(" \t\x0b\x0c\r")).alias("s"), i.alias("ln")))
    found = let(F.filter(lines, lambda x: x["s"] != ""), lambda a: F.transform(a, lambda x, i: F.struct(
        x["ln"].alias("ln"), F.xxhash64(x["s"]).alias("h1"), F.xxhash64(F.concat(F.lit("\n"), x["s"])).alias("h2"),
        F.size(F.split(x["s"], f"{BLANK}+")).alias("w"), (F.size(a) - i).alias("left"))))
    rows = docs.select(F.col(doc).alias("doc"), F.xxhash64(F.col(text)).alias("text_hash"), F.explode(found).alias("x")) \
        .select("doc", "text_hash", "x.*")
    # written before the range shuffle, which reads its input twice (once to sample the bounds)
    rows = materialise(rows, "lines")
    # one range shuffle serves all that follows: copies of a row, the running words and the numbering
    in_doc = Window.partitionBy("doc", "text_hash").orderBy("ln").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.repartitionByRange("doc", "text_hash").dropDuplicates(["doc", "text_hash", "ln"]) \
        .withColumn("before", F.coalesce(F.sum("w").over(in_doc), F.lit(0))) \
        .sortWithinPartitions("doc", "text_hash", "ln").withColumn("pos", F.monotonically_increasing_id())
    return materialise(placed.withColumn("stop", F.col("pos") + F.col("left")).drop("left"), "positions")


def _rank(rows: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, int]:
    """Number the repeated key combinations in key order and give each row its number.

    Returns the written table (pos, stop, r) of the rows whose keys repeat, and its size.
    """
    classes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where("c > 1") \
        .orderBy(*keys).withColumn("r", F.monotonically_increasing_id())
    classes = materialise(classes.withColumn("k", F.struct(*keys)).select("k", "c", "r"), f"{name}-classes")
    keyed = rows.select("pos", "stop", F.struct(*keys).alias("k"))
    ranked = materialise(join_weighted(keyed, classes, "k", "c", rows.count()).select("pos", "stop", "r"), name)
    return ranked, ranked.count()


def suffix_ranks(positions: DataFrame) -> list[DataFrame]:
    """Tables (pos, stop, r), one per round: rank of the repeated window of 2^k lines at pos."""
    rounds = []
    ranked, n = _rank(positions.select("pos", "stop", "h1", "h2"), ["h1", "h2"], "rank0")
    while n:
        rounds.append(ranked)
        step = 1 << (len(rounds) - 1)
        second = ranked.select((F.col("pos") - step).alias("pos"), F.col("r").alias("r2"))
        pairs = ranked.where(F.col("pos") + step < F.col("stop")).join(second, "pos")
        ranked, n = _rank(materialise(pairs.withColumnRenamed("r", "r1"), "pairs"), ["r1", "r2"], f"rank{len(rounds)}")
    return rounds


def previous_matches(rounds: list[DataFrame]) -> DataFrame:
    """(pos, lcp): lines of the longest match of the suffix at pos with an earlier place.

    Positions without an earlier match are absent.
    """
    def new_problems(k: int) -> DataFrame:
        """Round k's buckets split by round k + 1: (p1, p2, lo, pos, stop), pos the first of each part."""
        here = rounds[k].select("pos", "stop", F.col("r").alias("p1"))
        deeper = rounds[k + 1].select("pos", "r") if k + 1 < len(rounds) else None
        if deeper is None:
            parts = here
        else:
            j = here.join(deeper, "pos", "left")
            parts = j.where("r is null").select("pos", "stop", "p1").unionByName(
                j.where("r is not null").groupBy("r").agg(F.min("pos").alias("pos"), F.min_by("stop", "pos").alias("stop"),
                                                          F.first("p1").alias("p1")).drop("r"))
        return parts.select("p1", F.lit(-1 - k).cast("long").alias("p2"), F.lit(1 << k).cast("long").alias("lo"), "pos", "stop")

    top = len(rounds) - 1
    problems = materialise(new_problems(top), "problems")
    for j in range(top - 1, -1, -1):
        # all problems span 2^(j+1) lines from lo: look at the window of 2^j lines there
        look = problems.withColumn("at", F.col("pos") + F.col("lo")).join(
            rounds[j].select(F.col("pos").alias("at"), "r"), "at", "left") \
            .withColumn("r", F.when(F.col("at") < F.col("stop"), F.col("r"))).drop("at")
        look = materialise(look, "look")
        inner = look.where("r is not null")
        parts = materialise(inner.groupBy("p1", "p2", "lo", "r").agg(
            F.count(F.lit(1)).alias("c"), F.min("pos").alias("pos"), F.min_by("stop", "pos").alias("stop")), "parts")
        keyed = inner.select(F.struct("p1", "p2", "lo", "r").alias("k"), "pos", "stop")
        several = parts.where("c > 1").select(F.struct("p1", "p2", "lo", "r").alias("k"), "c")
        deeper = join_weighted(keyed, several, "k", "c", look.count()).select(
            F.xxhash64("k.p1", "k.p2", "k.lo", "k.r").alias("p1"), F.xxhash64("k.r", "k.lo", "k.p2", "k.p1").alias("p2"),
            (F.col("k.lo") + (1 << j)).alias("lo"), "pos", "stop")
        cols = ["p1", "p2", "lo", "pos", "stop"]
        upper = look.where("r is null").select(*cols).unionByName(parts.select(*cols))
        problems = materialise(deeper.unionByName(upper).unionByName(new_problems(j)), "problems")
    firsts = problems.groupBy("p1", "p2", "lo").agg(F.min("pos").alias("pos"))
    return problems.join(firsts, ["p1", "p2", "lo", "pos"], "left_anti").select("pos", F.col("lo").alias("lcp"))


def later_copies(positions: DataFrame, min_words: int) -> DataFrame:
    """(doc, text_hash, ln, w): the lines inside runs of at least ``min_words`` words that match an earlier place."""
    rounds = suffix_ranks(positions)
    if not rounds:
        return positions.where(F.lit(False)).select("doc", "text_hash", "ln", "w")
    runs = previous_matches(rounds).withColumn("last", F.col("pos") + F.col("lcp") - 1)
    ends = positions.select(F.col("pos").alias("last"), (F.col("before") + F.col("w")).alias("after"))
    starts = positions.select("pos", "before", "doc", "text_hash")
    long_runs = runs.join(ends, "last").join(starts, "pos").where(F.col("after") - F.col("before") >= min_words)
    long_runs = materialise(long_runs.select("doc", "text_hash", "pos", F.col("last").alias("reach")), "runs")
    # one document's lines at a time: a line goes when a run that began at or before it reaches it
    touched = long_runs.select("doc", "text_hash").distinct()
    same = lambda a, b: a["doc"].eqNullSafe(b["doc"]) & (a["text_hash"] == b["text_hash"])
    lines = positions.join(touched, same(positions, touched), "left_semi").select("doc", "text_hash", "ln", "w", "pos") \
        .join(long_runs.select("pos", "reach"), "pos", "left")
    so_far = Window.partitionBy("doc", "text_hash").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("reach", F.max("reach").over(so_far)).where("reach >= pos").select("doc", "text_hash", "ln", "w")


def dedup_lines(docs: DataFrame, text: str = "text", doc: str = "doc_id", min_words: int = 50) -> DataFrame:
    """``docs`` with later copies of repeated line runs taken out of ``text``, plus
    n_removed_lines and n_removed_words (long).

    Null and empty texts have no lines and pass unchanged, as do all other columns.  Ties:
    the first copy in (doc, text hash, line) order stays, null ids first; rows with the same
    doc and text are one document and change alike.  Texts of any length are cut into lines
    whole.  Other columns may have any name.  Empty table: empty result.
    """
    positions = line_positions(docs, text, doc)
    gone = later_copies(positions, min_words).groupBy("doc", "text_hash").agg(
        F.collect_list("ln").alias("gone"), F.sum("w").alias("gone_words"))
    # the row travels as one struct, so its column names cannot clash with the helper's
    rows = docs.select(F.struct("*").alias("row"), F.col(doc).alias("id"), F.xxhash64(F.col(text)).alias("h"))
    j = rows.join(gone, F.col("id").eqNullSafe(F.col("doc")) & (F.col("h") == F.col("text_hash")), "left")
    # array_except is a hash lookup and keeps the order: linear in the document's lines
    source = F.col("row").getField(text)
    kept = let(F.split(source, "\n"), lambda ls: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("gone")), lambda i: ls[i]), "\n"))
    clean = F.when(F.col("gone").isNull(), source).otherwise(kept)
    rest = [(clean if c == text else F.col("row").getField(c)).alias(c)
            for c in docs.columns if c not in ("n_removed_lines", "n_removed_words")]
    return j.select(*rest, F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed_lines"),
                    F.coalesce("gone_words", F.lit(0)).cast("long").alias("n_removed_words"))
