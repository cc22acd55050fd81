"""Window / panel operators against pandas and brute force."""

import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkpanel.operators import clean, panel


def _series(spark, values, series="s"):
    rows = [(series, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "s string, t int, v double")


def test_interpolate_like_pandas(spark):
    vals = [None, 1.0, None, None, 4.0, None]
    out = panel.interpolate_linear(_series(spark, vals), ["s"], "t", "v", "o").orderBy("t")
    got = [r.o for r in out.collect()]
    want = pd.Series(vals, dtype="float64").interpolate().tolist()
    assert got[0] is None and got[1:] == want[1:] == [1.0, 2.0, 3.0, 4.0, 4.0]


def test_ffill_bfill(spark):
    out = panel.ffill_bfill(_series(spark, [None, 1.0, None, 3.0, None]), ["s"], "t", "v", "o").orderBy("t")
    assert [r.o for r in out.collect()] == [1.0, 1.0, 1.0, 3.0, 3.0]
    allnull = panel.ffill_bfill(_series(spark, [None, None]), ["s"], "t", "v", "o")
    assert [r.o for r in allnull.collect()] == [None, None]


def test_rolling_min_periods_one(spark):
    vals = [float(i) for i in range(1, 8)]
    out = panel.rolling(_series(spark, vals), ["s"], "t", ["v"], 3).orderBy("t").collect()
    p = pd.Series(vals).rolling(3, min_periods=1)
    assert [r.v_sum3 for r in out] == p.sum().tolist()
    assert [r.v_avg3 for r in out] == p.mean().tolist()


def test_keep_first_total_order(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 1, "a"), (2, 5, "q")], "k int, o int, x string")
    got = sorted(map(tuple, panel.keep_first(df, ["k"], ["o"]).collect()))
    assert got == [(1, 1, "a"), (2, 5, "q")]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 50)), min_size=1, max_size=60))
def test_rank_within_groups_matches_brute_force(spark, rows):
    rows = [(g, v, i) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    got = {r.id: r["rank"] for r in panel.rank_within_groups(df, ["g"], ["v", "id"]).collect()}
    p = pd.DataFrame(rows, columns=["g", "v", "id"]).sort_values(["g", "v", "id"])
    p["rank"] = p.groupby("g").cumcount() + 1
    assert got == dict(zip(p["id"], p["rank"]))


def test_running_totals_match_cumsum(spark):
    random.seed(1)
    rows = [(float(random.randint(0, 30)), random.randint(0, 3)) for _ in range(200)]
    g = spark.createDataFrame(rows, "s double, w int").groupBy("s").agg(F.sum("w").alias("w"))
    got = {r.s: r.cum_w for r in panel.running_totals(g, "s", ["w"], descending=True).collect()}
    p = pd.DataFrame(rows, columns=["s", "w"]).groupby("s")["w"].sum().sort_index(ascending=False).cumsum()
    assert got == p.to_dict()


def test_curve_points_monotone(spark):
    rows = [(i / 10.0, 1 if i % 3 else 0) for i in range(10)] + [(0.5, 1), (0.5, 0)]
    c = panel.curve_points(spark.createDataFrame(rows, "score double, y int"), "score", "y").orderBy(F.desc("threshold"))
    pts = c.collect()
    assert pts[-1].tpr == 1.0 and pts[-1].fpr == 1.0
    assert all(a.tp <= b.tp and a.fp <= b.fp for a, b in zip(pts, pts[1:]))


def test_last_n_and_last_vs_previous(spark):
    df = _series(spark, [float(i) for i in range(10)])
    arr = panel.last_n(df, ["s"], "t", "v", 7).collect()[0].last_values
    assert arr == [3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    k = panel.last_vs_previous(df, ["s"], "t", "v").collect()[0]
    assert (k["last"], k.previous, k.change) == (9.0, 8.0, 1.0)


def test_date_spine_fills_gaps(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1.0), ("a", "2024-01-04", 2.0)], "s string, day string, v double") \
        .withColumn("day", F.to_date("day"))
    out = panel.on_spine(df, "day", ["s"]).orderBy("day").collect()
    assert [r.v for r in out] == [1.0, None, None, 2.0]


def test_top_n_per_group_salted(spark):
    rows = [("hot", i) for i in range(500)] + [("cold", i) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, v int")
    out = clean.top_n_per_group(df, ["g"], [F.desc("v")], 3, salt_buckets=16, salt_key=F.col("v"))
    got = sorted((r.g, r.v) for r in out.collect())
    assert got == sorted([("hot", 499), ("hot", 498), ("hot", 497), ("cold", 4), ("cold", 3), ("cold", 2)])


def test_rank_within_groups_large_is_a_permutation(spark):
    """Many partitions and a hot group (a third of the rows): ranks per group are exactly 1..n."""
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 97).cast("string"))).alias("g"),
        F.md5(F.col("id").cast("string")).alias("h"), "id")
    r = panel.rank_within_groups(df, ["g"], ["h", "id"])
    chk = r.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("rank").alias("d"),
                             F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    bad = chk.where("d <> n or lo <> 1 or hi <> n").count()
    assert bad == 0
    hot = chk.where("g = 'hot'").collect()[0]
    assert hot.n == 20000


def test_ranks_and_totals_keep_nulls_and_build_lazily(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 2.0, 2), (None, 1.0, 3), (None, None, 4), ("a", float("nan"), 5)], "g string, v double, id int")
    got = {r.id: r["rank"] for r in panel.rank_within_groups(df, ["g"], ["v", "id"]).collect()}
    assert got == {1: 1, 2: 2, 5: 3, 4: 1, 3: 2}
    assert {r.id: r.cum_id for r in panel.running_totals(df.where("g = 'a'"), "v", ["id"], descending=False).collect()} == {1: 1, 2: 3, 5: 8}
    boom = spark.range(3).select(F.assert_true(F.lit(False)).isNull().cast("double").alias("v"), "id")
    panel.running_totals(boom, "v", ["id"])
    panel.rank_within_groups(boom, [], ["v", "id"])


def _shares(df, column, groups=()):
    """Rows of the largest bucket, and buckets of the largest window of each level, as shares of the rows."""
    b = panel._bucketed(df, list(groups), column).cache()
    n = b.count()
    buckets = b.groupBy("__s", "__b", "__f").count()
    return (buckets.agg(F.max("count")).first()[0] / n, buckets.groupBy("__s", "__b").count().agg(F.max("count")).first()[0] / n,
            buckets.select("__s").distinct().count())


def test_buckets_spread_prices_times_and_texts_with_a_common_start(spark):
    ids = spark.range(60000)
    prices = ids.select((F.pmod(F.xxhash64("id"), F.lit(9_000_000)) / 100 + 900).alias("v")).distinct()
    names = ids.select(F.format_string("customer-%06d", "id").alias("v"))
    stamps = ids.select(F.expr("timestamp_ntz '2024-03-31 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("v"))
    long = ids.select(F.concat(F.repeat(F.lit("\u00e9"), 60), F.col("id").cast("string")).alias("v"))
    for df in (prices, names, stamps, long):
        rows, window, top = _shares(df, "v")
        assert rows <= 1 / 16 and window <= 1 / 8 and top <= 1500, (rows, window, top)


def test_prefix_scan_over_many_buckets_matches_pandas(spark):
    rng = random.Random(3)
    values = [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(3000)] + [0.0, float("inf"), float("-inf")]
    rows = [(v, i % 7) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "v double, w int")
    for down in (True, False):
        got = {r.v: r.cum_w for r in panel.running_totals(df, "v", ["w"], descending=down).collect()}
        want, total = {}, 0
        for v, w in sorted(rows, reverse=down):
            total += w
            want[v] = total
        assert got == want


def test_ranks_of_texts_dates_and_times(spark):
    rng = random.Random(8)
    texts = ["", "a", "ab", "abcd", "abcde", "abcd\u00e9", "abcd\U0001f642", "\u00e9", *(f"abcd{'x' * 300}{i}" for i in range(50)),
             *("".join(rng.choice("ab\u00e9z0") for _ in range(rng.randint(0, 9))) for _ in range(400))]
    rows = [(t if i % 50 else None, f"2024-{1 + i % 12:02d}-{1 + i % 28:02d} {i % 24:02d}:{i % 60:02d}:{(i * 7) % 60:02d}.{i % 1000:03d}", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "t string, s string, id int").withColumn("ntz", F.to_timestamp_ntz("s")) \
        .withColumn("ts", F.to_timestamp("s")).withColumn("d", F.to_date("s"))
    order = {"t": lambda r: (r[0] is not None, (r[0] or "").encode(), r[2]), "ntz": lambda r: (r[1], r[2]), "ts": lambda r: (r[1], r[2]),
             "d": lambda r: (r[1][:10], r[2])}
    for column, key in order.items():
        got = {r.id: r["rank"] for r in panel.rank_within_groups(df, [], [column, "id"]).collect()}
        assert got == {r[2]: i + 1 for i, r in enumerate(sorted(rows, key=key))}, column
