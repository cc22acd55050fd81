"""Sketch cells: merged estimates keep their bounds; nulls, NaN, hot and empty cells."""

import numpy as np
from pyspark.sql import functions as F

from sparkpanel.operators import preagg


def test_merged_sketches_keep_their_bounds(spark, tmp_path):
    df = spark.range(200_000).select(
        (F.col("id") % 24).alias("hour"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id"), F.lit(1_000_000)).cast("double")).alias("v"), (F.col("id") % 30_011).alias("u"))
    preagg.sketched_cells(df, ["hour", "g"], "v", "u").write.partitionBy("hour").parquet(str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    probs = {"p05": 0.05, "p50": 0.5, "p99": 0.99}
    for by in (["g"], []):
        est = {tuple(r[c] for c in by): r for r in preagg.estimates(preagg.roll_up(cells, by), probs).collect()}
        for r in (df.groupBy(*by) if by else df).agg(F.collect_list("v").alias("v"), F.count_distinct("u").alias("d"), F.count("v").alias("n")).collect():
            e, v = est[tuple(r[c] for c in by)], np.sort(r["v"])
            assert e["n"] == r["n"] and abs(e["mean"] - v.mean()) < 1e-6
            assert abs(e["n_distinct"] - r["d"]) <= preagg.DISTINCT_ERROR * r["d"]
            for name, p in probs.items():
                rank = np.searchsorted(v, e[name], side="right") / len(v)
                assert abs(rank - p) <= preagg.RANK_ERROR


def test_null_nan_and_empty_cells(spark):
    rows = [("a", None, 1), ("a", None, None), ("b", 1.0, None), ("b", float("nan"), 2), (None, 5.0, 3)]
    df = spark.createDataFrame(rows, "g string, v double, u long")
    cells = preagg.roll_up(preagg.sketched_cells(df, ["g"], "v", "u"), ["g"])
    got = {r.g: (r.n, r["mean"], r.p50, r.n_distinct) for r in preagg.estimates(cells, {"p50": 0.5}).collect()}
    assert got == {"a": (0, None, None, 1), "b": (1, 1.0, 1.0, 1), None: (1, 5.0, 5.0, 1)}
    assert preagg.sketched_cells(df.limit(0), ["g"], "v", "u").count() == 0


def test_ranks_of_values(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(10)] + [("a", None)], "g string, v double")
    at = spark.createDataFrame([("a", 4.0, -1.0)], "g string, x double, y double")
    r = preagg.rank_of(df, ["g"], "v", at, ["x", "y"]).first()
    assert (r.x_below, r.x_upto, r.y_below, r.y_upto) == (0.4, 0.5, 0.0, 0.0)
