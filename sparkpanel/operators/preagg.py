"""Pre-aggregates that roll up: sums and counts, and mergeable sketches for what sums cannot give.

A mean rolls up from its sum and count; a quantile or a distinct count does not.  So each
stored cell also keeps a KLL sketch of the values and a HyperLogLog sketch of the keys:
a few kilobytes whatever the rows, built with partial aggregation, and merged across cells.
Estimates carry bounds: ``RANK_ERROR`` for the rank of a KLL quantile, ``DISTINCT_ERROR``
(three standard deviations) for the relative error of a distinct count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fixed values of the two sketches: size parameters, and the error bounds that follow from them
KLL_K, HLL_LG_K = 800, 13
RANK_ERROR, DISTINCT_ERROR = 0.01, 3 * 1.04 / (1 << HLL_LG_K) ** 0.5


def sketched_cells(df: DataFrame, cell: list[str], value: str, distinct: str) -> DataFrame:
    """One row per cell: n, total, value_sketch (null without values) and distinct_sketch.

    Null and NaN values are not counted in n, total and the value sketch; null keys not in the distinct sketch.
    """
    v = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    return df.withColumn("__v", v).groupBy(*cell).agg(
        F.count("__v").alias("n"), F.sum("__v").alias("total"), F.kll_sketch_agg_double("__v", KLL_K).alias("value_sketch"),
        F.hll_sketch_agg(distinct, HLL_LG_K).alias("distinct_sketch"))


def roll_up(cells: DataFrame, by: list[str]) -> DataFrame:
    """Stored cells merged to coarser ones, without the rows they came from."""
    g = cells.groupBy(*by) if by else cells
    return g.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.kll_merge_agg_double("value_sketch", KLL_K).alias("value_sketch"),
                 F.hll_union_agg("distinct_sketch").alias("distinct_sketch"))


def estimates(cells: DataFrame, probs: dict[str, float]) -> DataFrame:
    """``cells`` with the sketches replaced by mean, one quantile per name in ``probs`` and n_distinct; quantiles of
    cells without values are null."""
    keys = [c for c in cells.columns if c not in ("value_sketch", "distinct_sketch")]
    some = F.col("n") > 0
    return cells.select(*keys, F.try_divide("total", "n").alias("mean"),
                        *[F.when(some, F.kll_sketch_get_quantile_double("value_sketch", F.lit(float(p)))).alias(n) for n, p in probs.items()],
                        F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"))


def rank_of(df: DataFrame, by: list[str], value: str, at: DataFrame, names: list[str]) -> DataFrame:
    """For every group and each name in ``names`` the share of values below, and at or below, ``at``'s column of that
    name (``<name>_below``, ``<name>_upto``): the exact ranks of estimates.  ``at`` has a row per group."""
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(*by, x.alias("__x")).join(at.select(*by, *names), by)
    share = lambda c: F.count_if(c) / F.count(F.lit(1))
    return rows.groupBy(*by).agg(*[share(F.col("__x") < F.col(n)).alias(f"{n}_below") for n in names],
                                 *[share(F.col("__x") <= F.col(n)).alias(f"{n}_upto") for n in names])


def keeps_rank(name: str, p: float):
    """Whether the exact ranks of an estimate (from ``rank_of``) are within the sketch's bound of ``p``."""
    return (F.col(f"{name}_below") <= p + RANK_ERROR) & (F.col(f"{name}_upto") >= p - RANK_ERROR)
