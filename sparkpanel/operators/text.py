"""Word frequency and TF-IDF over whole texts.

Tokenisation is a native regex split / extract; tokens are exploded and
counted with partial aggregation.  TF-IDF follows the smooth-idf, L2-norm
definition: idf = ln((1 + n) / (1 + df)) + 1, each document's weight vector
(restricted to the vocabulary) is L2-normalised, and term scores are summed
over documents.  The vocabulary (top terms by corpus frequency, ties by term)
is a bounded top-k, broadcast into the document-term table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The stop-word list of the keyword-frequency report.
STOP_WORDS = ["및", "그", "이", "그것", "저", "또는", "의", "를", "을", "은", "는", "가", "에", "로", "으로",
              "과", "와", "에서", "합니다", "있습니다", "하는", "할", "한", "등"]
# White space as Python's str.split and Unicode regex classes know it (also ideographic and no-break spaces).
BLANKS = r"\s\x1c-\x1f\x{85}\p{Z}"
# Characters kept by the frequency report: Hangul syllables, ASCII letters, digits, blanks.
KEEP_CLASS = rf"[^가-힣a-zA-Z0-9{BLANKS}]"
# Token class of the TF-IDF reports: letters, digits, underscore (unicode word characters).
WORD_RUN = r"[\p{L}\p{N}_]+"
NON_WORD_RUN = r"[^\p{L}\p{N}_]+"


def clean_for_frequency(text: Column) -> Column:
    """strip HTML tags, then every character outside KEEP_CLASS.

    One regex pass with alternation: at a '<' the tag branch is tried first, any
    other dropped character is consumed alone, so the result equals tag removal
    followed by character removal.
    """
    return F.regexp_replace(text, r"<[^>]+>|" + KEEP_CLASS, "")


def spread(df: DataFrame, bytes_per_core: int = 32 << 20) -> DataFrame:
    """Deal the rows of a small scan to all cores (one small file is one task otherwise).

    Decided by the scan's size: a table of more than ``bytes_per_core`` per core has splits
    enough and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * bytes_per_core else df


def frequency_tokens(df: DataFrame, text: str, keep: list[str] | None = None, min_len: int = 2,
                     stop_words: list[str] | None = None) -> DataFrame:
    """whitespace tokens of the cleaned text, length >= min_len, stop words removed."""
    keep = keep or []
    stop_words = STOP_WORDS if stop_words is None else stop_words
    cleaned = clean_for_frequency(F.coalesce(F.col(text), F.lit("")))
    t = spread(df.select(*keep, text)).select(*keep, F.explode(F.split(cleaned, f"[{BLANKS}]+")).alias("token"))
    return t.where((F.length("token") >= min_len) & ~F.col("token").isin(stop_words))


def word_frequency(df: DataFrame, text: str, k: int = 15) -> DataFrame:
    """H1: the k most frequent tokens (ties by token)."""
    c = frequency_tokens(df, text).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.desc("n"), "token").limit(k)


def word_frequency_by_group(df: DataFrame, text: str, group: str, k: int = 15) -> DataFrame:
    """H2: top-k tokens per group (salted two-stage top-k: a hot group is split)."""
    from sparkpanel.operators.clean import top_n_per_group

    c = frequency_tokens(df, text, keep=[group]).groupBy(group, "token").agg(F.count(F.lit(1)).alias("n"))
    top = top_n_per_group(c, [group], [F.desc("n"), F.asc("token")], k, salt_key=F.col("token"))
    return top.withColumnRenamed("__rank", "rank")


def tfidf_top(df: DataFrame, doc_id: str, text: str, vocab_size: int = 30, top: int = 30,
              min_token_len: int = 2) -> DataFrame:
    """H4/H5: vocabulary-limited TF-IDF, summed per term, top terms.

    NULL texts are dropped first (they are not documents); documents without a
    vocabulary term keep a zero vector and add nothing.

    Plan: (1) corpus term totals with a partial aggregation (one small row per
    distinct term per task), (2) the vocabulary = top ``vocab_size`` terms,
    broadcast (bounded by the parameter), (3) tokens filtered against it BEFORE the
    document-term shuffle, so that shuffle carries at most ``vocab_size`` terms per
    document instead of every distinct (document, term) pair.  Tokenising twice
    costs CPU; the full document-term table would cost a far larger shuffle.
    """
    docs = spread(df.where(F.col(text).isNotNull()).select(doc_id, text)).select(doc_id, F.lower(F.col(text)).alias("__t"))
    n_docs = docs.agg(F.count(F.lit(1)).cast("double")).scalar()
    # maximal runs of word characters = split on runs of non-word characters (faster than extract_all)
    toks = docs.select(doc_id, F.explode(F.split("__t", NON_WORD_RUN)).alias("term")) \
        .where(F.length("term") >= max(min_token_len, 1))
    cf = toks.groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
    vocab = cf.orderBy(F.desc("cf"), "term").limit(vocab_size).select("term")
    # the vocabulary holds at most vocab_size rows: broadcast by construction
    dt = toks.join(F.broadcast(vocab), "term").groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("tf"))
    idf = dt.groupBy("term").agg((F.log((1 + n_docs) / (1 + F.count(F.lit(1)))) + 1).alias("idf"))
    w = dt.join(F.broadcast(idf), "term").select(doc_id, "term", (F.col("tf") * F.col("idf")).alias("w"))
    # each document has at most vocab_size rows here, so the per-document window is bounded
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc_id)))
    scored = w.select("term", (F.col("w") / norm).alias("x"))
    return scored.groupBy("term").agg(F.sum("x").alias("score")).orderBy(F.desc("score"), "term").limit(top)
