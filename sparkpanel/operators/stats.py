"""Aggregation and distribution statistics.

All operators are single- or few-pass DataFrame aggregations.  Group-by keys
are aggregated with Spark's partial (map-side) aggregation, so a hot key is
pre-combined in every task before the shuffle.  Wide results are produced in
long form (column, metric, value) and pivoted only at the edge.

Exact quantiles and modes never use Spark's ``percentile`` / ``median`` /
``mode`` aggregates: those keep every distinct value of a group in ONE
aggregation buffer (one task), which a group holding a third of the data
cannot survive.  ``quantiles`` counts values and narrows them down by value buckets to the
two neighbouring order statistics;
``mode_values`` counts values with a partial aggregation.  ``approx=True``
switches quantiles to the bounded-memory ``percentile_approx`` sketch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpanel.functions import columns as C
from sparkpanel.functions.columns import (equal_width_bin, kurt_sample, safe_corr, safe_ratio,
                                          skew_sample, value_bucket)


def attach(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Join two per-group results on the group keys; with no keys both sides hold one row."""
    if by:
        return left.join(right, by)
    k = "__one"
    return left.withColumn(k, F.lit(1)).join(right.withColumn(k, F.lit(1)), k).drop(k)


#: sub-buckets of a value bucket
_FINE = 4096


def quantiles(df: DataFrame, col: str, probs: dict[str, float], by: list[str] | None = None,
              approx: bool = False) -> DataFrame:
    """Linear-interpolated quantiles (the pandas / ``percentile`` definition) per group.

    Exact and lazy, without sorting the table.  Rows collapse to one count per (group, value)
    in the map tasks, so a value that most rows share costs nothing.  Counts are added up per
    bucket of values (a monotone function of the value), a running sum over the buckets of a
    group shows which buckets hold a wanted rank, and only the values of those buckets go on:
    to sub-buckets between the bucket's smallest and largest value, and at last to the values
    themselves.  A task never holds a group, only its buckets or the values of one sub-bucket.
    Null keys and values are left out.  Output: by + one column per name in ``probs``.
    """
    by = list(by or [])
    x = F.col(col).cast("double")
    v = df.select(*by, x.alias("__x")).where(F.col("__x").isNotNull())
    if approx:
        ps = list(probs.values())
        g = (v.groupBy(*by) if by else v).agg(F.percentile_approx("__x", ps, 10000).alias("__q"))
        return g.select(*by, *[F.col("__q")[i].alias(n) for i, n in enumerate(probs)])
    # SQL text instead of column calls: the plan is the same and is built in far fewer calls to the JVM
    names = [f"`{c.rpartition('.')[2]}`" for c in by]
    if by:
        v = v.where(" and ".join(f"{c} is not null" for c in names))
    position = {name: f"((__n - 1) * {float(p)!r}D)" for name, p in probs.items()}
    lower = {name: f"(floor({at}) + 1)" for name, at in position.items()}
    upper = {name: f"(ceil({at}) + 1)" for name, at in position.items()}
    wanted = f"array({', '.join([*lower.values(), *upper.values()])})"

    def over(keys: list[str], order: str) -> str:
        part = f"partition by {', '.join(keys)} " if keys else ""
        return f"over ({part}order by {order} rows between unbounded preceding and current row)"

    def holding(buckets: DataFrame, keys: list[str], bucket: str) -> DataFrame:
        """Buckets in which a wanted rank falls; __base: values of the group before the bucket."""
        run = buckets.selectExpr("*", f"__start + sum(__c) {over(keys, bucket)} as __to").selectExpr("*", "__to - __c as __base")
        return run.where(f"exists({wanted}, r -> r > __base and r <= __to)")

    keys = [c.rpartition(".")[2] for c in by]
    counts = v.groupBy(*keys, "__x").agg(F.expr("count(1) as __c")).withColumn("__b", value_bucket(F.col("__x")))
    coarse = counts.groupBy(*keys, "__b").agg(F.expr("sum(__c) as __c"), F.expr("min(__x) as __lo"), F.expr("max(__x) as __hi"))
    whole = f"sum(__c) over ({'partition by ' + ', '.join(names) if names else ''}) as __n"
    first = holding(coarse.selectExpr("*", whole, "bigint(0) as __start"), names, "__b").select(*keys, "__b", "__n", "__base", "__lo", "__hi")
    part = f"least(int(floor((__x - __lo) / (__hi - __lo) * {_FINE})), {_FINE - 1})"
    inner = counts.join(first, [*keys, "__b"]).selectExpr("*", f"case when __hi > __lo then {part} else 0 end as __f")
    fine = inner.groupBy(*keys, "__b", "__f").agg(F.expr("sum(__c) as __c"), F.expr("first(__n) as __n"), F.expr("first(__base) as __start"))
    second = holding(fine, [*names, "__b"], "__f").selectExpr(*names, "__b", "__f", "__base as __start")
    run = inner.join(second, [*keys, "__b", "__f"]).selectExpr("*", f"__start + sum(__c) {over([*names, '__b', '__f'], '__x')} as __to")
    aggs = []
    for name in probs:
        aggs += [F.expr(f"max(case when {r} <= __to and {r} > __to - __c then __x end) as `__{side}_{name}`")
                 for side, r in (("lo", lower[name]), ("hi", upper[name]))]
        aggs.append(F.expr(f"first({position[name]} - floor({position[name]})) as `__f_{name}`"))
    g = (run.groupBy(*keys) if keys else run).agg(*aggs)
    return g.selectExpr(*names, *[f"`__lo_{n}` + (`__hi_{n}` - `__lo_{n}`) * `__f_{n}` as `{n}`" for n in probs])


def mode_values(df: DataFrame, col: str, by: list[str] | None = None, name: str = "mode") -> DataFrame:
    """Most frequent value per group, smallest value on ties.

    Values are counted with a partial aggregation (one row per distinct value),
    then ``min_by`` keeps the winner: no buffer ever holds all values of a group.
    """
    by = list(by or [])
    c = df.where(F.col(col).isNotNull()).groupBy(*by, F.col(col).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    g = (c.groupBy(*by) if by else c).agg(F.min_by("__v", F.struct(-F.col("__c"), F.col("__v"))).alias(name))
    return g


def drop_null_keys(df: DataFrame, keys) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    cond = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(cond)


# ---------------------------------------------------------------- counting

def value_counts(df: DataFrame, col: str, keep_nulls: bool = False, name: str = "n") -> DataFrame:
    """Frequency table, most frequent first, ties by value (A1)."""
    src = df if keep_nulls else drop_null_keys(df, col)
    return src.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc(col))


def group_counts(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """``groupby(keys).size()``."""
    return drop_null_keys(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Top-k with a caller-given total order (TakeOrderedAndProject, T2)."""
    return df.orderBy(*order).limit(k)


# ---------------------------------------------------------------- profiles

def kpi_row(df: DataFrame) -> DataFrame:
    """Rows, columns and the total number of null cells in one pass (A10)."""
    nulls = [F.count_if(F.col(c).isNull()) for c in df.columns]
    total = reduce(lambda a, b: a + b, nulls) if nulls else F.lit(0)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
                  total.cast("bigint").alias("n_nulls"))


def null_summary(df: DataFrame, only_positive: bool = True) -> DataFrame:
    """Null count and percentage per column, descending."""
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = row.unpivot("__n", df.columns, "column_name", "n_null")
    out = long.select("column_name", "n_null",
                      C.round_half_away(safe_ratio(F.col("n_null") * 100.0, F.col("__n")), 4).alias("pct_null"))
    if only_positive:
        out = out.where(F.col("n_null") > 0)
    return out.orderBy(F.desc("n_null"), F.asc("column_name"))


def describe_numeric(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles, max for every column.

    The columns are unpivoted once, so moments and quartiles of all columns come
    from one aggregation and one ranked pass keyed by column name.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
                                         for c in cols])).alias("s")).select("s.*")
    m = long.groupBy("column_name").agg(F.count("v").alias("count"), F.avg("v").alias("mean"),
                                        F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    q = quantiles(long, "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, by=["column_name"], approx=approx)
    return m.join(q, "column_name", "left").select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_categorical(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, unique, top, freq per text column (A13); ties for top -> smallest value."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                  F.col(c).cast("string").alias("value"))
                                         for c in cols])).alias("kv")).select("kv.*")
    freq = long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("freq"))
    return freq.groupBy("column_name").agg(
        F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by(F.struct(F.col("value").alias("top"), F.col("freq")),
                 F.struct(-F.col("freq"), F.col("value"))).alias("_t"),
    ).select("column_name", "count", "unique", "_t.top", "_t.freq")


def mode_of(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value; smallest value on ties."""
    return mode_values(df, col)


def duplicate_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row over ``cols`` (``duplicated().sum()``, A14)."""
    cols = cols or df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"),
                 F.count_if(F.col("__n") > 1).alias("n_groups"))


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once, with the group size (A15, keep=False).

    The group sizes come from a partial aggregation (skew-safe) and are joined back;
    no window over a possibly hot key is needed.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    return df.join(sizes, keys, "inner")


# ---------------------------------------------------------------- correlation

def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(safe_corr(x, y).alias("r"), F.count_if(F.col(x).isNotNull() & F.col(y).isNotNull()).alias("n"))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """All pairwise r in one aggregation, returned long (var_x, var_y, r) incl. diagonal."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"),
                            safe_corr(a, b).alias("r")).alias(f"{a}__{b}") for a, b in pairs])
    upper = row.select(F.inline(F.array(*[F.col(f"{a}__{b}") for a, b in pairs])))
    lower = upper.where("var_x <> var_y").select(F.col("var_y").alias("var_x"),
                                                  F.col("var_x").alias("var_y"), "r")
    return upper.unionByName(lower)


def ols_pair(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Least-squares line and r."""
    by = by or []
    aggs = [F.regr_slope(F.col(y), F.col(x)).alias("slope"),
            F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
            F.regr_r2(F.col(y), F.col(x)).alias("r2"), safe_corr(x, y).alias("r"),
            F.regr_count(F.col(y), F.col(x)).alias("n")]
    return (df.groupBy(*by) if by else df).agg(*aggs)


# ---------------------------------------------------------------- one-column stats

def column_stats(df: DataFrame, col: str, by: list[str] | None = None, approx: bool = False) -> DataFrame:
    """min, max, mean, median, mode, std, skew, kurtosis."""
    by = list(by or [])
    x = F.col(col).cast("double")
    aggs = [F.count(x).alias("n"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), skew_sample(x).alias("skew"), kurt_sample(x).alias("kurt")]
    m = (df.groupBy(*by) if by else df).agg(*aggs)
    med = quantiles(df, col, {"median": 0.5}, by, approx)
    mode = mode_values(df.select(*by, x.alias(col)), col, by)
    out = attach(attach(m, med, by), mode, by)
    return out.select(*by, "n", "min", "max", "mean", "median", "mode", "std", "skew", "kurt")


def quartile_spread(df: DataFrame, col: str, by: list[str] | None = None, approx: bool = False) -> DataFrame:
    """q1, q3, IQR and CV = std/|mean|."""
    by = list(by or [])
    x = F.col(col).cast("double")
    m = (df.groupBy(*by) if by else df).agg(F.stddev_samp(x).alias("std"), F.avg(x).alias("mean"))
    g = attach(quantiles(df, col, {"q1": 0.25, "q3": 0.75}, by, approx), m, by)
    return g.withColumn("iqr", F.col("q3") - F.col("q1")).withColumn(
        "cv", safe_ratio(F.col("std"), F.abs(F.col("mean"))))


# ---------------------------------------------------------------- histogram / box / density

def histogram(df: DataFrame, col: str, n_bins: int = 10, lo=None, hi=None) -> DataFrame:
    """Equal-width histogram with empty bins present.

    Bounds default to the column min/max, evaluated once as scalar subqueries of
    the same query (no driver round trip, no join).
    """
    x = F.col(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    # one scalar subquery returning both bounds (Spark evaluates it once and reuses it)
    b = vals.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo_c = b.getField("lo") if lo is None else F.lit(float(lo))
    hi_c = b.getField("hi") if hi is None else F.lit(float(hi))
    counts = vals.select(equal_width_bin("x", lo_c, hi_c, n_bins).alias("bin")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"))
    spark = vals.sparkSession
    spine = spark.range(1, n_bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (hi_c - lo_c) / F.lit(n_bins)
    return spine.join(counts, "bin", "left").select(
        "bin", (lo_c + (F.col("bin") - 1) * width).alias("bin_lo"), (lo_c + F.col("bin") * width).alias("bin_hi"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def box_stats(df: DataFrame, col: str, by: list[str], approx: bool = False) -> DataFrame:
    """Quartiles, fences at 1.5 IQR and whiskers clipped to the data."""
    x = F.col(col).cast("double")
    q = quantiles(df, col, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by, approx)
    q = q.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    j = df.select(*by, x.alias("__x")).join(q, by, "inner")
    w = j.groupBy(*by).agg(
        F.min(F.when(F.col("__x") >= F.col("lo_fence"), F.col("__x"))).alias("whisker_lo"),
        F.max(F.when(F.col("__x") <= F.col("hi_fence"), F.col("__x"))).alias("whisker_hi"),
        F.count_if((F.col("__x") < F.col("lo_fence")) | (F.col("__x") > F.col("hi_fence"))).alias("n_outliers"))
    return q.join(w, by, "inner")


def box_outliers(df: DataFrame, col: str, by: list[str], approx: bool = False) -> DataFrame:
    """Rows outside the 1.5 IQR fences of their group."""
    x = F.col(col).cast("double")
    q = quantiles(df, col, {"q1": 0.25, "q3": 0.75}, by, approx)
    j = df.join(q, by, "inner")
    iqr = F.col("q3") - F.col("q1")
    return j.where((x < F.col("q1") - 1.5 * iqr) | (x > F.col("q3") + 1.5 * iqr)).drop("q1", "q3")


def kde_grid(df: DataFrame, col: str, n_grid: int = 64, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density on an even grid (A39), over every value.

    Equal values collapse to one weighted value (partial aggregation); one more aggregation
    holds a sum per grid point, so each value is read once and nothing is multiplied out.
    Bandwidth defaults to Scott's rule, n^(-1/5) * std.
    """
    x = F.col(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    # one scalar subquery with every statistic the grid needs (evaluated once, reused)
    st = vals.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").cast("double").alias("n"),
                           (F.stddev_samp("x") * F.pow(F.count("x").cast("double"), F.lit(-0.2))).alias("bw"))).scalar()
    # as plain doubles: a struct in the buffer would make the aggregation sort
    weighted = vals.groupBy("x").agg(F.count(F.lit(1)).alias("w")).select("x", "w", *[st.getField(c).alias(c) for c in ("lo", "hi", "n", "bw")])
    lo, hi = F.col("lo"), F.col("hi")
    bw = F.lit(float(bandwidth)) if bandwidth else F.col("bw")
    at = lambda g: lo + F.lit(g) * (hi - lo) / F.lit(n_grid - 1)
    z = lambda g: (at(g) - F.col("x")) / bw
    sums = weighted.agg(*[F.max(c).alias(c) for c in ("lo", "hi", "n", "bw")], *[F.sum(F.col("w") * F.exp(-0.5 * z(g) * z(g))).alias(f"s{g}") for g in range(n_grid)])
    scale = F.col("n") * bw * F.lit((2 * 3.141592653589793) ** 0.5)
    rows = [F.struct(F.lit(g).alias("g"), at(g).alias("x"), (F.col(f"s{g}") / scale).alias("density")) for g in range(n_grid)]
    return sums.where(F.col("n") > 0).select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- misc

def trend_ratio(df: DataFrame, ts: str, by: str, unit: str = "day") -> DataFrame:
    """Count per (key, period) rescaled so the busiest period of the key = 100."""
    c = df.groupBy(F.col(by), F.date_trunc(unit, F.col(ts)).alias("period")).agg(F.count(F.lit(1)).alias("n"))
    mx = c.groupBy(by).agg(F.max("n").alias("__mx"))
    return c.join(mx, by).select(by, "period", "n",
                                 (F.col("n") * 100.0 / F.col("__mx")).alias("ratio"))


def shape_class(skew: Column, kurt: Column) -> tuple[Column, Column]:
    """Interpretation classes for skew (±0.5) and excess kurtosis (±1)."""
    s = (F.when(skew.isNull(), "n/a").when(skew > 0.5, "right-skewed")
         .when(skew < -0.5, "left-skewed").otherwise("symmetric"))
    k = (F.when(kurt.isNull(), "n/a").when(kurt > 1, "heavy-tailed")
         .when(kurt < -1, "light-tailed").otherwise("normal-tailed"))
    return s, k


def corr_strength(r: Column) -> Column:
    a = F.abs(r)
    return F.when(r.isNull(), "n/a").when(a >= 0.7, "strong").when(a >= 0.4, "moderate").otherwise("weak")
