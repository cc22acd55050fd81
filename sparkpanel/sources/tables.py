"""Readers for the supplied star-schema tables.

Every table is one Parquet file per name under ``sf_dir``.  Reads are lazy: column
pruning and filter pushdown reach the scan through Catalyst, so callers should
select / filter right after ``table(...)`` rather than caching whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLE_NAMES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the tables of one scale-factor folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def register_views(self) -> None:
        """Expose all tables as temp views (for ``spark.sql`` based operators)."""
        for name in TABLE_NAMES:
            table(self.spark, self.sf_dir, name).createOrReplaceTempView(name)
