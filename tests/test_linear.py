"""Least-squares models per item against numpy; singular and small items."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkpanel.operators import linear


def test_coefficients_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for item, n in (("a", 300), ("b", 25), (None, 60)):
        x = rng.normal(size=(n, 4)) * [1, 1e3, 1e-3, 5] + [0, 1e6, 0, -7]
        y = x @ rng.normal(size=4) + 3 + rng.normal(size=n) * 0.1
        rows += [(item, *map(float, r), float(t)) for r, t in zip(x, y)]
        want[item] = np.linalg.lstsq(np.c_[x - x.mean(0)], y - y.mean(), rcond=None)[0]
        want[item, "i"] = y.mean() - want[item] @ x.mean(0)
        want[item, "r2"] = 1 - ((y - x @ want[item] - want[item, "i"]) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    rows += [("a", None, 1.0, 1.0, 1.0, 1.0), ("a", float("nan"), 1.0, 1.0, 1.0, 1.0), ("a", 1.0, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "item string, x1 double, x2 double, x3 double, `x 4` double, y double").repartition(5)
    got = {r.item: r for r in linear.fit_items(df, ["item"], ["x1", "x2", "x3", "x 4"], "y").collect()}
    assert set(got) == {"a", "b", None} and got["a"].n == 300
    for item, r in got.items():
        assert r.mode == "model"
        assert r.coefficients == pytest.approx(want[item].tolist(), rel=1e-7)
        assert r.intercept == pytest.approx(want[item, "i"], rel=1e-6, abs=1e-4) and r.r2 == pytest.approx(want[item, "r2"], rel=1e-9)
    one = linear.fit_items(df, ["item"], ["x1", "x2", "x3", "x 4"], "y").withColumn("p", linear.predicted([F.lit(1.0), F.lit(1e6), F.lit(0.0), F.lit(2.0)]))
    for r in one.collect():
        assert r.p == pytest.approx(want[r.item] @ [1, 1e6, 0, 2] + want[r.item, "i"], rel=1e-6)


def test_singular_and_small_items_fall_back(spark):
    rows = [("flat", 1.0, float(i), float(i)) for i in range(50)] + [("twice", float(i), 2.0 * i, float(i % 7)) for i in range(50)]
    rows += [("small", float(i), float(i * i), 1.0) for i in range(10)] + [("none", None, None, 1.0)] + [("ok", float(i), float(i * i), 5.0) for i in range(30)]
    df = spark.createDataFrame(rows, "item string, a double, b double, y double")
    got = {r.item: (r.mode, r.n, r.coefficients is None) for r in linear.fit_items(df, ["item"], ["a", "b"], "y").collect()}
    assert got == {"flat": ("rule", 50, True), "twice": ("rule", 50, True), "small": ("rule", 10, True), "none": ("rule", 0, True), "ok": ("model", 30, False)}
    assert linear.fit_items(df.limit(0), ["item"], ["a"], "y").count() == 0
