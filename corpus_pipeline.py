"""Corpus pipeline: language ID, quality rules, line dedup, SimHash near-dedup, packing.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkpanel.llm import language_id, line_dedup, packing, quality_lines, simhash
from sparkpanel.llm.common import materialise
from sparkpanel.sources.tables import table

#: a document whose best language has less than this share of the likelihood is rejected
MIN_LANGUAGE_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters, near ties, and those of whose words their language knows too few:
    gibberish and languages that were not learned.  Null and empty texts have no letters.  Repeated rows are judged
    alike; texts of any length are read whole; all columns pass through, whatever their names; empty in, empty out."""
    own = {c: f"__own_{c}" for c in ("lang_pred", "score", "lang_known", "lang_clear") if c in docs.columns}
    kept = language_id.identify(docs.withColumnsRenamed(own), clear=True).where(
        (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE) & F.col("lang_clear"))
    return kept.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that fail the base rule or are depleted by frequent lines.  Null and empty texts fail the
    base rule.  Repeated rows get one verdict and all stay or go; other cases as in the stage before."""
    verdict = quality_lines.judge(docs, with_text_hash=True).where("kept").select("doc_id", "text_hash").distinct()
    rows = docs.withColumn("__h", F.xxhash64("text"))
    return rows.join(verdict, rows["doc_id"].eqNullSafe(verdict["doc_id"]) & (rows["__h"] == verdict["text_hash"]), "left_semi") \
        .select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later copies of line runs; documents left without a word go; n_chars follows the text.  Rows with the
    same id and text change alike; null and empty texts pass; other cases as in the first stage."""
    clean = line_dedup.dedup_lines(docs).where(F.col("n_removed_lines").eqNullSafe(0) | F.rlike("text", F.lit("[^ \\t-\\r]")))
    return clean.withColumn("n_chars", F.when(F.col("n_removed_lines") > 0, F.length("text").cast("long"))
                            .otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component, the one with the smallest doc_id (null ids last); of repeated rows one.
    Null and empty texts are one component; other cases as in the first stage."""
    return simhash.one_of_each(docs, shingle=3, max_bits=2)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences of at most 1024 tokens; repeated rows are packed
    each, null and empty texts as the end token alone; no documents, no rows."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [("language_id", language_stage), ("quality_rules", quality_stage), ("line_dedup", line_stage),
          ("simhash_near_dedup", near_duplicate_stage), ("best_fit_packing", packing_stage)]

#: SQL expresses neither the tokenizer nor the suffix order; the tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
