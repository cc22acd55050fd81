"""Quality rules: cross-document line frequency, after per-text base counts.

Native DataFrame functions only.  A line (``\\n``-split, lower-cased, white space
collapsed) is hashed; for every host the number of distinct documents (distinct texts, so
exact copies count once) that hold the line is counted; lines above the host's limit are
removed; a document that loses more than ``max_removed`` of its words is depleted and
rejected, as is one that fails the base rule.

Limit of a host: a line is above it when it occurs in more than ``min_docs`` documents and
in more than ``share`` of the host's documents or more than their square root, whichever
is less.  So the limit acts on hosts of a few dozen documents and grows slowly on large
ones: 5 documents up to 500, 100 at 10,000, 2,000 at four million.

Counting runs per (host, line): duplicates collapse in the map tasks, then (host, line,
text) rows spread over all tasks before they are counted.  Frequent lines meet the
documents again through ``join_weighted``: hot lines (fewer than 1,000 can exist) are
broadcast, the rest joins by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm.common import join_weighted, let, materialise

BLANKS = " \t\n\x0b\x0c\r"
#: up to so many repeated windows are looked up one by one; more are matched by sorting
FEW = 16


def words_column(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; empty array for null or blank texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")


def _covered(positions: Column) -> Column:
    """Words covered by 3-word windows that start at the given ascending positions."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(positions, start, lambda a, p: F.struct(
        p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text (first included).

    Windows are compared by a 64-bit hash.  Sorting the hashes shows which repeat; if only
    a few do, each window is looked up among them, otherwise (hash, position) pairs are
    sorted and equal neighbours marked, so the cost stays n log n for any text.
    """
    def marked_by_sort(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.array_sort(F.transform(F.filter(s, lambda p, k: (
            (k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == p["h"]))
            | ((k < F.size(s) - 1) & (s[F.least(k + 1, F.size(s) - 1)]["h"] == p["h"]))), lambda p: p["i"])))

    def marked_by_lookup(h: Column, repeated: Column) -> Column:
        return F.array_compact(F.transform(h, lambda x, i: F.when(F.array_contains(repeated, x), i)))

    def of_hashes(h: Column) -> Column:
        # a sorted array beside itself moved by one: equal neighbours are repeated hashes
        repeated = let(F.sort_array(h), lambda s: F.array_distinct(F.array_compact(
            F.zip_with(s, F.slice(s, 2, F.size(s)), lambda x, y: F.when(x == y, x)))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(repeated, lambda r: _covered(
            F.when(F.size(r) <= FEW, marked_by_lookup(h, r)).otherwise(marked_by_sort(h)))))

    # every word is hashed once; a window's hash is made of its three words' hashes
    hashes = let(F.transform(words, lambda x: F.xxhash64(x)), lambda h: F.slice(F.transform(
        h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))), 1, F.size(h) - 2))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(hashes, of_hashes))


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit("[^ \\t-\\r]")))

    def counts(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                        repeat_words(w).cast("long").alias("n_repeat_words"))

    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in new]
    c = docs.withColumn("__c", let(words_column(F.col(text)), counts)).select(*kept, "__c.*")
    return c.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def line_table(docs: DataFrame, text: str, host: str, doc: str) -> DataFrame:
    """One row per distinct normalised line of a document: doc, host, text hash, line hash,
    the line's words (all its occurrences in the document)."""
    tidy = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), "[ \\t\\x0B\\f\\r]+", " ")
    lines = F.filter(F.transform(F.split(tidy, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    pairs = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("w")))
    return docs.select(F.col(doc).alias("doc"), F.coalesce(F.col(host), F.lit("")).alias("host"),
                       F.xxhash64(F.col(text)).alias("text_hash"), F.explode(pairs).alias("p")) \
        .select("doc", "host", "text_hash", "p.line", "p.w")


def frequent_lines(lines: DataFrame, min_docs: int, share: float) -> DataFrame:
    """(host, line, n_docs, n_rows): lines in more than ``min_docs`` distinct documents and more than
    ``share`` or the square root of the host's distinct documents, whichever is less."""
    per_text = lines.groupBy("host", "line", "text_hash").agg(F.count(F.lit(1)).alias("r"))
    per_line = per_text.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("r").alias("n_rows")) \
        .where(F.col("n_docs") > min_docs)
    hosts = lines.select("host", "text_hash").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    return per_line.join(hosts, "host").where(F.col("n_docs") > F.least(F.col("host_docs") * share, F.sqrt("host_docs"))).drop("host_docs")


def judge(docs: DataFrame, text: str = "text", host: str = "source", doc: str = "doc_id", min_docs: int = 5,
          share: float = 0.01, max_removed: float = 0.5, with_text_hash: bool = False) -> DataFrame:
    """Base counts plus ``n_removed_words`` (words in lines above the limit) and ``kept``, one
    row per row of ``docs`` with the columns ``doc`` and the counts.

    Null and empty text: no words, so the base rule fails.  Null host: a host of its own.
    Rows with the same ``doc`` and text are the same document and get the same verdict; rows
    that share only ``doc`` are told apart by their text (``with_text_hash`` adds its
    xxhash64).  Very long texts are read whole, line by line.  A line on the limit stays.
    Other columns, whatever their names, are not read.  Empty table: empty result.
    """
    d = docs.select(F.col(doc), F.col(text), F.col(host))
    lines = materialise(line_table(d, text, host, doc).withColumn("key", F.xxhash64("host", "line")), "lines")
    frequent = materialise(frequent_lines(lines, min_docs, share).withColumn("key", F.xxhash64("host", "line"))
                           .select("key", "n_rows"), "frequent")
    n_rows = lines.count()
    hit = join_weighted(lines.select("doc", "text_hash", "key", "w"), frequent, "key", "n_rows", n_rows)
    # rows of a repeated document were counted once per copy: divide by the copies
    removed = hit.groupBy("doc", "text_hash").agg(F.sum("w").alias("removed"))
    copies = d.groupBy(F.col(doc).alias("doc"), F.xxhash64(F.col(text)).alias("text_hash")).agg(F.count(F.lit(1)).alias("copies"))
    removed = removed.join(copies.where("copies > 1"), [removed["doc"].eqNullSafe(copies["doc"]), removed["text_hash"] == copies["text_hash"]], "left") \
        .select(removed["doc"], removed["text_hash"], (F.col("removed") / F.coalesce("copies", F.lit(1))).cast("long").alias("removed"))
    base = base_counts(d, text).withColumn("text_hash", F.xxhash64(F.col(text))).drop(text, host)
    j = base.join(removed, [base[doc].eqNullSafe(removed["doc"]), base["text_hash"] == removed["text_hash"]], "left")
    gone = F.coalesce(F.col("removed"), F.lit(0))
    return j.select(base[doc], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (gone <= F.col("n_words") * max_removed)).alias("kept"),
                    gone.cast("long").alias("n_removed_words"), *([base["text_hash"]] if with_text_hash else []))
