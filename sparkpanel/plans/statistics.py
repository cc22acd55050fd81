"""Hypothesis tests, funnels, rules and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.functions.columns import kurt_sample, safe_corr, skew_sample
from sparkpanel.operators import hypothesis as H
from sparkpanel.operators import stats
from sparkpanel.functions import columns as C
from sparkpanel.plans.registry import query
from sparkpanel.sources.tables import Tables

R = 4


@query("welch_t", f"""
with s as (select count(*) filter (where o_orderstatus = 'F') as n_a, count(*) filter (where o_orderstatus = 'O') as n_b,
  avg(o_totalprice) filter (where o_orderstatus = 'F') as mean_a, avg(o_totalprice) filter (where o_orderstatus = 'O') as mean_b,
  var_samp(o_totalprice) filter (where o_orderstatus = 'F') as var_a, var_samp(o_totalprice) filter (where o_orderstatus = 'O') as var_b
  from orders)
select n_a, n_b, round(mean_a, {R}) as mean_a, round(mean_b, {R}) as mean_b,
  round((mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b), {R}) as t,
  round(pow(var_a / n_a + var_b / n_b, 2) / (pow(var_a / n_a, 2) / (n_a - 1) + pow(var_b / n_b, 2) / (n_b - 1)), {R}) as dof
from s""", headline=True)
def welch_t(spark, sf):
    """Welch t of order price, status F vs O (statistic and df)."""
    o = Tables(spark, sf).orders
    w = H.welch_t(o, "o_totalprice", F.col("o_orderstatus"), "F", "O")
    return w.select("n_a", "n_b", *[C.round_half_away(c, R).alias(c) for c in ["mean_a", "mean_b", "t", "dof"]])


_WELCH_SQL = """(select n_a, n_b, mean_a, mean_b, var_a, var_b, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) as t,
  pow(var_a / n_a + var_b / n_b, 2) / (pow(var_a / n_a, 2) / (n_a - 1) + pow(var_b / n_b, 2) / (n_b - 1)) as dof
  from (select count(*) filter (where o_orderstatus = 'F') as n_a, count(*) filter (where o_orderstatus = 'O') as n_b,
  avg(o_totalprice) filter (where o_orderstatus = 'F') as mean_a, avg(o_totalprice) filter (where o_orderstatus = 'O') as mean_b,
  var_samp(o_totalprice) filter (where o_orderstatus = 'F') as var_a, var_samp(o_totalprice) filter (where o_orderstatus = 'O') as var_b from orders))"""


# midpoint sums of the t density's tail in z = angle * sqrt(dof), 200,000 steps
@query("welch_t_test", f"""
with w as {_WELCH_SQL},
z as (select *, atan(abs(t) / sqrt(dof)) * sqrt(dof) as lo, least(pi() / 2 * sqrt(dof), atan(abs(t) / sqrt(dof)) * sqrt(dof) + 40) as hi from w),
i as (select sum(exp((dof - 1) * ln(cos((lo + (g + 0.5) * (hi - lo) / 200000) / sqrt(dof))))) * max(hi - lo) / 200000 as s
      from z, (select unnest(range(200000)) as g))
select n_a, n_b, round(t, {R}) as t, round(dof, {R}) as dof,
       round(2 * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(pi() * dof) * s, 6) as p_value from z, i""")
def welch_t_test(spark, sf):
    """A51 with the two-sided p-value (quadrature in an Arrow UDF on one row)."""
    o = Tables(spark, sf).orders
    w = H.welch_t(o, "o_totalprice", F.col("o_orderstatus"), "F", "O", with_p=True)
    return w.select("n_a", "n_b", C.round_half_away("t", R).alias("t"), C.round_half_away("dof", R).alias("dof"),
                    C.round_half_away("p_value", 6).alias("p_value"))


def _status_segment(spark, sf):
    t = Tables(spark, sf)
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return t.orders.select("o_custkey", "o_orderstatus").join(c, "o_custkey")


_CHI_SQL = """
with o as (select o_orderstatus, c_mktsegment from orders join customer on o_custkey = c_custkey),
r as (select distinct o_orderstatus from o), c as (select distinct c_mktsegment from o),
cells as (select r.o_orderstatus, c.c_mktsegment, (select count(*) from o where o.o_orderstatus = r.o_orderstatus
          and o.c_mktsegment = c.c_mktsegment) as observed from r, c),
e as (select *, sum(observed) over (partition by o_orderstatus) * sum(observed) over (partition by c_mktsegment)
                / sum(observed) over () as expected from cells)
select round(sum(pow(abs(observed - expected), 2) / expected), {R}) as chi2, cast((count(distinct o_orderstatus) - 1) * (count(distinct c_mktsegment) - 1) as int) as dof,
       cast(sum(observed) as bigint) as n from e
""".format(R=R)


@query("chi_square", _CHI_SQL)
def chi_square(spark, sf):
    """Independence of order status and customer segment (3 x 5, dof 8)."""
    c = H.chi_square(_status_segment(spark, sf), "o_orderstatus", "c_mktsegment")
    return c.select(C.round_half_away("chi2", R).alias("chi2"), "dof", F.col("n").cast("bigint"))


@query("chi_square_yates", f"""
with o as (select o_orderstatus = 'F' as is_f, c_mktsegment = 'BUILDING' as is_b
           from orders join customer on o_custkey = c_custkey),
cells as (select r.is_f, c.is_b, (select count(*) from o where o.is_f = r.is_f and o.is_b = c.is_b) as observed
          from (select unnest([false, true]) as is_f) r, (select unnest([false, true]) as is_b) c),
e as (select *, sum(observed) over (partition by is_f) * sum(observed) over (partition by is_b)
                / sum(observed) over () as expected from cells)
select round(sum(pow(abs(observed - expected) - least(0.5, abs(observed - expected)), 2) / expected), {R}) as chi2,
       1 as dof, cast(sum(observed) as bigint) as n from e""")
def chi_square_yates(spark, sf):
    """A52 on a 2 x 2 table: Yates' correction applies (dof = 1)."""
    j = _status_segment(spark, sf).select((F.col("o_orderstatus") == "F").alias("is_f"),
                                          (F.col("c_mktsegment") == "BUILDING").alias("is_b"))
    c = H.chi_square(j, "is_f", "is_b", yates=True)
    return c.select(C.round_half_away("chi2", R).alias("chi2"), "dof", F.col("n").cast("bigint"))


# even degrees of freedom: the upper tail is a finite sum
@query("chi_square_test", f"""
with x as ({_CHI_SQL.replace(f'round(sum(pow(abs(observed - expected), 2) / expected), {R})', 'sum(pow(abs(observed - expected), 2) / expected)')})
select round(chi2, {R}) as chi2, dof, n,
       round(exp(-chi2 / 2) * (select sum(pow(chi2 / 2, k) / gamma(k + 1)) from (select unnest(range(4)) as k)), 8) as p_value from x""")
def chi_square_test(spark, sf):
    """A52 with the p-value (the finite sum of the upper tail in an Arrow UDF on one row)."""
    c = H.chi_square(_status_segment(spark, sf), "o_orderstatus", "c_mktsegment", with_p=True)
    return c.select(C.round_half_away("chi2", R).alias("chi2"), "dof", F.col("n").cast("bigint").alias("n"), C.round_half_away("p_value", 8).alias("p_value"))


# ------------------------------------------------------------------ funnels

def _sessions(spark, sf):
    """events per user -> one 'session' row with per-type counts (the shopper table)."""
    e = Tables(spark, sf).events
    types = ["view", "click", "signup", "purchase", "error"]
    return e.groupBy("user_id").agg(*[F.count_if(F.col("event_type") == t).alias(f"n_{t}") for t in types],
                                    F.sum("value").alias("total_value"))


_SESS_SQL = """(select user_id, count(*) filter (where event_type = 'view') as n_view,
  count(*) filter (where event_type = 'click') as n_click, count(*) filter (where event_type = 'signup') as n_signup,
  count(*) filter (where event_type = 'purchase') as n_purchase, count(*) filter (where event_type = 'error') as n_error
  from events group by user_id)"""

_STEPS = [("visit", "true"), ("view", "n_view > 0"), ("click", "n_click > 0"), ("purchase", "n_purchase > 0")]


def _funnel_sql(by: str | None) -> str:
    sel = f"{by}, " if by else ""
    grp = f"group by {by}" if by else ""
    conds, cols = [], []
    for i, (_, c) in enumerate(_STEPS):
        conds.append(c)
        cols.append(f"count(*) filter (where {' and '.join(conds)}) as s{i}")
    stack = " union all ".join(f"select {sel}{i + 1} as step, '{n}' as step_name, s{i} as n, a from g"
                               for i, (n, _) in enumerate(_STEPS))
    part = f"partition by {by} " if by else ""
    return f"""
with u as (select *, case when n_signup > 0 then 'new' else 'returning' end as segment from {_SESS_SQL}),
g as (select {sel}count(*) as a, {', '.join(cols)} from u {grp}),
l as ({stack})
select {sel}step, step_name, n, round(n * 100.0 / nullif(a, 0), {R}) as pct_all,
       round(n * 100.0 / nullif(coalesce(lag(n) over ({part}order by step), a), 0), {R}) as pct_prev from l"""


def _funnel_steps():
    return [("visit", F.lit(True)), ("view", F.col("n_view") > 0), ("click", F.col("n_click") > 0),
            ("purchase", F.col("n_purchase") > 0)]


@query("funnel", _funnel_sql(None), headline=True)
def funnel(spark, sf):
    f = H.funnel(_sessions(spark, sf), _funnel_steps())
    return f.select("step", "step_name", "n", C.round_half_away("pct_all", R).alias("pct_all"), C.round_half_away("pct_prev", R).alias("pct_prev"))


@query("funnel_by_segment", _funnel_sql("segment"))
def funnel_by_segment(spark, sf):
    s = _sessions(spark, sf).withColumn("segment", F.when(F.col("n_signup") > 0, "new").otherwise("returning"))
    f = H.funnel(s, _funnel_steps(), by=["segment"])
    return f.select("segment", "step", "step_name", "n", C.round_half_away("pct_all", R).alias("pct_all"),
                    C.round_half_away("pct_prev", R).alias("pct_prev"))


@query("conversion_rate", f"""
select count(*) as sessions, count(*) filter (where n_purchase > 0) as purchases,
       round(avg(case when n_purchase > 0 then 1.0 else 0.0 end), {R}) as rate from {_SESS_SQL}""")
def conversion_rate(spark, sf):
    """Overall conversion as the mean of a 0/1 flag."""
    s = _sessions(spark, sf)
    return s.agg(F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("n_purchase") > 0).alias("purchases"),
                 C.round_half_away(F.avg(F.when(F.col("n_purchase") > 0, 1.0).otherwise(0.0)), R).alias("rate"))


# ------------------------------------------------------------------ rules / profiles

@query("alert_rules", f"""
with d as (select event_type, cast(ts as date) as day, max(value) as hi, sum(value) as total, avg(value) as mean
           from events group by 1, 2),
a as (select event_type, count(*) filter (where hi >= 480) as hot_days, sum(total) as total, avg(mean) as mean
      from d group by 1)
select event_type, hot_days, round(total, {R}) as total, round(mean, {R}) as mean,
  case when hot_days >= 3 then 'heat' when total > 100000 then 'rain' when mean < 99 then 'cold' else 'normal' end as alert,
  (hot_days >= 3 or total > 100000 or mean < 99) as is_alert from a""")
def alert_rules(spark, sf):
    """Ordered threshold rules over daily aggregates -> alert code + flag."""
    e = Tables(spark, sf).events
    d = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.max("value").alias("hi"), F.sum("value").alias("total"),
                                                                  F.avg("value").alias("mean"))
    a = d.groupBy("event_type").agg(F.count_if(F.col("hi") >= 480).alias("hot_days"), F.sum("total").alias("total"),
                                    F.avg("mean").alias("mean"))
    alert = (F.when(F.col("hot_days") >= 3, "heat").when(F.col("total") > 100000, "rain")
             .when(F.col("mean") < 99, "cold").otherwise("normal"))
    return a.select("event_type", "hot_days", C.round_half_away("total", R).alias("total"), C.round_half_away("mean", R).alias("mean"),
                    alert.alias("alert"), (alert != "normal").alias("is_alert"))


_PROFILE_COLS = ["c_custkey", "c_nationkey", "c_acctbal"]


@query("profile_table", " union all ".join(f"""
select '{c}' as column_name, metric, round(value, {R}) as value from (
  select count({c})::double as n, (count(*) - count({c}))::double as nulls, avg({c}) as mean, stddev_samp({c}) as std,
         min({c})::double as min, median({c})::double as median, max({c})::double as max, skewness({c}) as skew,
         count(distinct {c})::double as n_distinct from customer)
unpivot (value for metric in (n, nulls, mean, std, min, median, max, skew, n_distinct))""" for c in _PROFILE_COLS))
def profile_table(spark, sf):
    """One job, long output (column, metric, value) for every profiled column.

    All columns are unpivoted once; moments, null and distinct counts come from
    one grouped aggregation, the medians from one ranked pass keyed by column.
    """
    c = Tables(spark, sf).customer
    long = c.select(F.explode(F.array(*[F.struct(F.lit(col).alias("column_name"), F.col(col).cast("double").alias("x"))
                                        for col in _PROFILE_COLS])).alias("s")).select("s.*")
    m = long.groupBy("column_name").agg(
        F.count("x").cast("double").alias("n"), (F.count(F.lit(1)) - F.count("x")).cast("double").alias("nulls"),
        F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"),
        skew_sample("x").alias("skew"), F.count_distinct("x").cast("double").alias("n_distinct"))
    m = m.join(stats.quantiles(long, "x", {"median": 0.5}, ["column_name"]), "column_name", "left")
    metrics = ["n", "nulls", "mean", "std", "min", "median", "max", "skew", "n_distinct"]
    out = m.unpivot("column_name", metrics, "metric", "value")
    return out.select("column_name", "metric", C.round_half_away("value", R).alias("value"))


_SHAPE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("shape_class", " union all ".join(f"""
select '{c}' as column_name, round(skewness({c}), {R}) as skew, round(kurtosis({c}), {R}) as kurt,
  case when skewness({c}) is null then 'n/a' when skewness({c}) > 0.5 then 'right-skewed'
       when skewness({c}) < -0.5 then 'left-skewed' else 'symmetric' end as skew_class,
  case when kurtosis({c}) is null then 'n/a' when kurtosis({c}) > 1 then 'heavy-tailed'
       when kurtosis({c}) < -1 then 'light-tailed' else 'normal-tailed' end as kurt_class,
  case when abs(skewness({c})) > 1 or kurtosis({c}) > 3 then true else false end as warn,
  case when abs(covar_pop({c}, l_extendedprice) / nullif(stddev_pop({c}) * stddev_pop(l_extendedprice), 0)) >= 0.7 then 'strong'
       when abs(covar_pop({c}, l_extendedprice) / nullif(stddev_pop({c}) * stddev_pop(l_extendedprice), 0)) >= 0.4 then 'moderate'
       else 'weak' end as r_class
from lineitem""" for c in _SHAPE_COLS))
def shape_class(spark, sf):
    """Interpretation classes from skew / kurtosis / r thresholds, all columns in one pass."""
    li = Tables(spark, sf).lineitem
    aggs = [F.struct(F.lit(c).alias("column_name"), skew_sample(c).alias("skew"), kurt_sample(c).alias("kurt"),
                     safe_corr(c, "l_extendedprice").alias("r")).alias(c) for c in _SHAPE_COLS]
    long = li.agg(*aggs).select(F.inline(F.array(*[F.col(c) for c in _SHAPE_COLS])))
    sk, ku = stats.shape_class(F.col("skew"), F.col("kurt"))
    warn = F.coalesce((F.abs("skew") > 1) | (F.col("kurt") > 3), F.lit(False))
    return long.select("column_name", C.round_half_away("skew", R).alias("skew"), C.round_half_away("kurt", R).alias("kurt"),
                       sk.alias("skew_class"), ku.alias("kurt_class"), warn.alias("warn"),
                       stats.corr_strength(F.col("r")).alias("r_class"))
