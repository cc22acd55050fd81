"""Join operators.

Physical join choice is left to Catalyst/AQE: a side is broadcast from its measured
shuffle bytes when it is below ``spark.sql.autoBroadcastJoinThreshold``, never from a row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.functions.columns import try_cast

def dimension_join(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Fact -> dimension lookup (J2/J5); AQE broadcasts the dimension if its bytes are small."""
    return fact.join(dim, on, how)


def normalise_code(c) -> F.Column:
    """Codes arriving as int, float or text -> bigint; unparsable -> NULL (never 0)."""
    col = F.col(c) if isinstance(c, str) else c
    return try_cast(try_cast(F.trim(col.cast("string")), "double"), "bigint")


def lookup_with_default(fact: DataFrame, dim: DataFrame, key: str, value: str,
                        default, out: str | None = None) -> DataFrame:
    """Dictionary lookup with a default for unknown keys."""
    out = out or value
    joined = dimension_join(fact, dim.select(key, F.col(value).alias("__v")), key, "left")
    return joined.withColumn(out, F.coalesce(F.col("__v"), F.lit(default))).drop("__v")


def semi_topk(fact: DataFrame, key: str, k: int, weight: str | None = None) -> DataFrame:
    """Keep rows of ``fact`` whose key is among its own k most frequent keys.

    The top-k key list is at most k rows, so it is broadcast by construction.
    """
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(
        (F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("__n"))
    top = counts.orderBy(F.desc("__n"), F.asc(key)).limit(k).select(key)
    return fact.join(F.broadcast(top), key, "left_semi")


def full_outer_fill(left: DataFrame, right: DataFrame, key: str, fill_cols: list[str],
                    fill=0) -> DataFrame:
    """Full outer join on ``key`` with the measure columns zero-filled."""
    j = left.join(right, key, "full")
    return j.select(key, *[F.coalesce(F.col(c), F.lit(fill)).alias(c) for c in fill_cols])
