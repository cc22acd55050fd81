"""Aggregation / statistics operators against hand values and pandas."""

import math

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkpanel.functions import columns as C
from sparkpanel.operators import reshape, stats


def _one(df):
    return df.collect()[0]


def test_moments_match_pandas(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = _one(df.agg(C.skew_sample("x").alias("s"), C.kurt_sample("x").alias("k"), F.stddev_samp("x").alias("sd")))
    assert r.s == pytest.approx(1.7636326, rel=1e-6)
    assert r.k == pytest.approx(3.228, rel=1e-6)
    assert r.sd == pytest.approx(4.0824829, rel=1e-6)
    q = _one(stats.quartile_spread(df, "x"))
    assert (q.q1, q.q3) == (pytest.approx(1.75), pytest.approx(4.75))


def test_moment_guards(spark):
    const = spark.createDataFrame([(5.0,)] * 4, "x double")
    r = _one(const.agg(C.skew_sample("x").alias("s"), C.skew_guarded("x").alias("g"), C.kurt_guarded("x").alias("k")))
    assert r.s is None and r.g == 0.0 and r.k == 0.0
    for n in (1, 2, 3):
        d = spark.createDataFrame([(float(i),) for i in range(n)], "x double")
        r = _one(d.agg(C.skew_guarded("x").alias("g"), C.kurt_guarded("x").alias("k")))
        assert r.k == 0.0
        if n < 3:
            assert r.g == 0.0


def test_safe_corr_constant_and_pairwise(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "x double, y double")
    assert _one(df.agg(C.safe_corr("x", "y").alias("r"))).r is None
    df2 = spark.createDataFrame([(1.0, 1.0), (2.0, None), (3.0, 3.0), (None, 9.0), (4.0, 4.5)], "x double, y double")
    r = _one(df2.agg(C.safe_corr("x", "y").alias("r"))).r
    p = pd.DataFrame({"x": [1, 2, 3, None, 4], "y": [1, None, 3, 9, 4.5]})
    assert r == pytest.approx(p["x"].corr(p["y"]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.floats(-100, 100), st.floats(-100, 100)), min_size=3, max_size=30))
def test_corr_matrix_symmetric_and_bounded(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double")
    m = {(r.var_x, r.var_y): r.r for r in stats.corr_matrix(df, ["a", "b"]).collect()}
    assert m[("a", "b")] == m[("b", "a")]
    if m[("a", "b")] is not None:
        assert -1 - 1e-9 <= m[("a", "b")] <= 1 + 1e-9


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.0,), (1.0,)], "x double")
    h = {r.bin: r.n for r in stats.histogram(df, "x", 5).collect()}
    assert h == {1: 2, 2: 0, 3: 0, 4: 0, 5: 2}  # the upper edge goes to the last bin, empty bins present
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    h2 = {r.bin: r.n for r in stats.histogram(same, "x", 3).collect()}
    assert h2 == {1: 2, 2: 0, 3: 0}  # lo == hi -> one bin


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e3, 1e3), min_size=1, max_size=40), st.integers(1, 12))
def test_histogram_counts_sum_to_n(spark, xs, bins):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert sum(r.n for r in stats.histogram(df, "x", bins).collect()) == len(xs)


def test_value_counts_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
    assert [tuple(r) for r in stats.value_counts(df, "k").collect()] == [("a", 2), ("b", 1)]
    assert dict((r.k, r.n) for r in stats.value_counts(df, "k", keep_nulls=True).collect())[None] == 1


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "x", 1), (1, "x", 1), (1, "x", 2), (2, "y", 3)], "a int, b string, o int")
    r = _one(stats.duplicate_count(df))
    assert r.n_duplicates == 1
    g = stats.duplicate_groups(df, ["a", "b"]).collect()
    assert len(g) == 3 and all(x.group_size == 3 for x in g)


def test_describe_categorical_tie_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "k string")
    r = _one(stats.describe_categorical(df, ["k"]))
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (5, 3, "a", 2)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["r1", "r2", "r3"]), st.sampled_from(["A", "B"])), min_size=1, max_size=40))
def test_crosstab_margins_equal_sums(spark, rows):
    df = spark.createDataFrame(rows, "r string, c string")
    w = {r.r: r for r in reshape.crosstab_wide(df, "r", "c", ["A", "B"], "Total").collect()}
    body = [v for k, v in w.items() if k != "Total"]
    assert w["Total"].total == len(rows)
    assert w["Total"].A == sum(v.A for v in body) and w["Total"].B == sum(v.B for v in body)
    assert all(v.A + v.B == v.total for v in w.values())


def test_pivot_duplicate_fails(spark):
    df = spark.createDataFrame([("d1", "x", 1.0), ("d1", "x", 2.0)], "d string, item string, v double")
    with pytest.raises(Exception):
        reshape.pivot_unique(df, "d", "item", "v", ["x"]).collect()


def test_unpivot_then_pivot_is_identity(spark):
    df = spark.createDataFrame([("d1", 1.0, 2.0), ("d2", 3.0, None)], "d string, x double, y double")
    long = reshape.unpivot_measures(df, ["d"], ["x", "y"], "item", "v")
    back = reshape.pivot_unique(long, "d", "item", "v", ["x", "y"])
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_zero_denominator(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (None, 1.0), (3.0, 2.0)], "a double, b double")
    out = [r.r for r in df.select(C.safe_ratio("a", "b").alias("r")).collect()]
    assert out == [None, None, None, 1.5]


def test_kde_integrates_to_one(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 2, 3, 3, 3, 4, 4, 5, 9]], "x double")
    k = sorted(stats.kde_grid(df, "x", n_grid=400).collect(), key=lambda r: r.g)
    step = k[1].x - k[0].x
    area = sum(r.density for r in k) * step
    assert 0.8 < area <= 1.01  # the grid covers [min, max] only, tails fall outside
    assert all(not math.isnan(r.density) for r in k)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2", "g3"]), st.integers(-50, 50)), min_size=1, max_size=80))
def test_distributed_quantiles_match_numpy(spark, rows):
    import numpy as np

    spark.conf.set("spark.sql.shuffle.partitions", "5")  # several range partitions per group
    try:
        df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g string, v double")
        got = {r.g: (r.q1, r.med, r.q9) for r in
               stats.quantiles(df, "v", {"q1": 0.1, "med": 0.5, "q9": 0.9}, by=["g"]).collect()}
        for g in {g for g, _ in rows}:
            xs = np.array([v for gg, v in rows if gg == g], dtype=float)
            want = np.percentile(xs, [10, 50, 90])  # linear interpolation, the pandas default
            assert got[g] == pytest.approx(tuple(want))
        allq = stats.quantiles(df, "v", {"m": 0.5}).collect()[0].m
        assert allq == pytest.approx(float(np.percentile([float(v) for _, v in rows], 50)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_mode_values_tie_smallest(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("a", 3.0), ("a", 1.0), ("b", 7.0), ("a", None)], "g string, v double")
    assert {r.g: r.mode for r in stats.mode_values(df, "v", ["g"]).collect()} == {"a": 1.0, "b": 7.0}
    assert stats.mode_values(df, "v").collect()[0].mode == 1.0


def test_quantiles_approx_path_close(spark):
    df = spark.range(10001).select((F.col("id") * 1.0).alias("v"))
    q = stats.quantiles(df, "v", {"p50": 0.5, "p90": 0.9}, approx=True).collect()[0]
    assert abs(q.p50 - 5000) <= 10 and abs(q.p90 - 9000) <= 10


def test_quantiles_survive_ties_extremes_and_groups(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    cols = {"hot": np.where(rng.random(3000) < 0.9, 7.25, rng.random(3000)), "wide": rng.standard_normal(3000) * 10.0 ** rng.integers(-9, 9, 3000),
            "near": 100 + rng.random(3000) * 1e-6, "neg": -rng.integers(0, 5, 3000).astype(float)}
    for name, v in cols.items():
        df = spark.createDataFrame([(i % 3, float(x)) for i, x in enumerate(v)] + [(None, 1.0), (1, None)], "g int, x double")
        got = {r.g: r for r in stats.quantiles(df, "x", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}, ["g"]).collect()}
        assert set(got) == {0, 1, 2}
        for g in got:
            want = np.quantile(v[np.arange(3000) % 3 == g], [0, 0.25, 0.5, 0.999, 1])
            assert np.allclose([got[g][c] for c in "abcde"], want, rtol=1e-12, atol=0), (name, g)
    assert stats.quantiles(df.where("false"), "x", {"m": 0.5}).first()["m"] is None


def test_quantiles_are_lazy_and_do_not_checkpoint(spark):
    df = spark.range(10).select(F.assert_true(F.lit(False), F.lit("built eagerly")).isNull().cast("double").alias("x"))
    stats.quantiles(df, "x", {"m": 0.5})


def test_kde_is_the_sum_over_every_value(spark):
    import numpy as np

    v = np.array([1.0, 1.0, 2.0, 5.5, 9.0, 9.5])
    got = stats.kde_grid(spark.createDataFrame([(float(x),) for x in v], "x double"), "x", n_grid=7).orderBy("g").collect()
    bw = v.std(ddof=1) * len(v) ** -0.2
    grid = np.linspace(1, 9.5, 7)
    want = np.exp(-0.5 * ((grid[:, None] - v[None, :]) / bw) ** 2).sum(axis=1) / (len(v) * bw * np.sqrt(2 * np.pi))
    assert np.allclose([r.density for r in got], want, rtol=1e-12)
