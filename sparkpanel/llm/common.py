"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpanel.session import ensure_checkpoint_dir, scratch_path

#: A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are fewer than HOT_SHARE hot keys.
HOT_SHARE = 1000


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the lineage ends
    there, so a lost executor costs a re-read, and the rows cannot change on a retry."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (small iteration state)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times inside ``body`` (also inside lambdas).

    Catalyst may inline a column that a lambda reads and then evaluates it once per
    array element; a lambda variable is evaluated exactly once.
    """
    return F.transform(F.array(value), body)[0]


def with_rank(df: DataFrame, groups: list[str], spread: str, order: list[str], n_rows: int,
              name: str = "rank", rows_per_bucket: int = 50_000) -> DataFrame:
    """0-based gapless number of every row inside its group, without gathering a group.

    Rows of a group are dealt to buckets by a hash of ``spread``, a column that differs
    between any two rows (a stored row number), so equal rows spread as well; the bucket
    sizes (one row per group and bucket) give each bucket its offset and a window numbers the
    rows inside one bucket.  A group gets as many buckets as it needs for ``rows_per_bucket``
    rows in each; ``n_rows`` (of the table) lowers that on small tables, so that they too are
    many tasks.  The groups must be few: their sizes are broadcast.  ``df`` must be stable (a
    written table): it is read twice.
    """
    per_bucket = max(500, min(rows_per_bucket, n_rows // 256))
    size = df.groupBy(*groups).agg(F.ceil(F.count(F.lit(1)) / per_bucket).cast("long").alias("__n"))
    b = df.join(F.broadcast(size), groups).withColumn("__b", F.pmod(F.xxhash64(spread), F.col("__n"))).drop("__n")
    sizes = b.groupBy(*groups, "__b").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(*groups).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*groups, "__b", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__o"))
    local = b.withColumn("__r", F.row_number().over(Window.partitionBy(*groups, "__b").orderBy(*order)) - 1)
    return local.join(offsets, [*groups, "__b"]).withColumn(name, F.col("__r") + F.col("__o")).drop("__b", "__r", "__o")


def join_weighted(left: DataFrame, right: DataFrame, key: str, weight: str, n_rows: int) -> DataFrame:
    """Inner join of many rows (``left``) with one row per key (``right``) whose column
    ``weight`` counts the key's rows in ``left`` (``n_rows`` altogether).

    Fewer than HOT_SHARE keys can hold more than 1/HOT_SHARE of the rows each: those rows
    of ``right`` are broadcast (a proven bound), all others join by shuffle, where no key
    is hot.  ``left`` and ``right`` are read twice and should be written tables.
    """
    limit = max(1, n_rows // HOT_SHARE)
    hot = F.broadcast(right.where(F.col(weight) > limit))
    cold = right.where(F.col(weight) <= limit)
    return left.join(hot, key).unionByName(left.join(hot.select(key), key, "left_anti").join(cold, key))
