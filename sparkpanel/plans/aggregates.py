"""Aggregation queries over the supplied tables, with DuckDB oracles.

Stand-ins (SURVEY 7.4): customer segment = store brand, nation = region,
part = books/products, events per user = shopper sessions, events per day =
daily weather, orders per day and priority = daily price per item.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.functions import columns as C
from sparkpanel.functions.columns import safe_corr, safe_ratio
from sparkpanel.operators import stats
from sparkpanel.operators.joins import dimension_join
from sparkpanel.operators.reshape import listed
from sparkpanel.plans.registry import query
from sparkpanel.sources.tables import Tables

R = 4  # digits kept for floating results compared against the oracle

# The five market segments of the customer table (pivot column list).
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _seg_col(s: str) -> str:
    return s.lower()


# ------------------------------------------------------------------ flagship (A18 + A30 + A27)

def ratio_index_query(spark, sf):
    """Nation x segment counts, ratio index and median balance.

    customer -> nation is a dimension lookup (broadcast by AQE from its measured size);
    the counts are a fixed-list pivot written as conditional counts (one
    shuffle on n_name with map-side partial aggregation); the exact median comes
    from ``stats.quantiles``.
    """
    t = Tables(spark, sf)
    cust = t.customer.select("c_nationkey", listed("c_mktsegment", SEGMENTS).alias("c_mktsegment"), "c_acctbal")
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = dimension_join(cust, nation, "c_nationkey", "inner")
    g = j.groupBy("n_name").agg(
        *[F.count_if(F.col("c_mktsegment") == s).alias(_seg_col(s)) for s in SEGMENTS],
        F.count(F.lit(1)).alias("total"))
    g = g.join(stats.quantiles(j, "c_acctbal", {"median_acctbal": 0.5}, ["n_name"]), "n_name", "left")
    return g.select(
        "n_name", *[_seg_col(s) for s in SEGMENTS], "total",
        C.round_half_away(safe_ratio(F.col("building") + F.col("automobile") + F.col("machinery"),
                           F.col("household")), R).alias("ratio_index"),
        C.round_half_away("median_acctbal", R).alias("median_acctbal"))


_RATIO_SQL = """
select n.n_name,
  {segs},
  count(*) as total,
  round((count(*) filter (where c_mktsegment = 'BUILDING') + count(*) filter (where c_mktsegment = 'AUTOMOBILE')
         + count(*) filter (where c_mktsegment = 'MACHINERY'))
        / nullif(count(*) filter (where c_mktsegment = 'HOUSEHOLD'), 0), {R}) as ratio_index,
  round(median(c_acctbal), {R}) as median_acctbal
from customer c join nation n on c.c_nationkey = n.n_nationkey
group by n.n_name
""".format(segs=",\n  ".join(f"count(*) filter (where c_mktsegment = '{s}') as {_seg_col(s)}" for s in SEGMENTS), R=R)

query("ratio_index", _RATIO_SQL, headline=True)(ratio_index_query)


@query("high_ratio_regions", f"select * from ({_RATIO_SQL}) where ratio_index >= 1.5")
def high_ratio_regions(spark, sf):
    """Threshold on a safe ratio (NULL ratios drop out, no inf handling needed)."""
    return ratio_index_query(spark, sf).where(F.col("ratio_index") >= 1.5)


# ------------------------------------------------------------------ counts

@query("value_counts", "select p_brand, count(*) as n from part where p_brand is not null group by p_brand")
def value_counts(spark, sf):
    return stats.value_counts(Tables(spark, sf).part, "p_brand")


@query("recent_periods", """
select cast(date_trunc('month', o_orderdate) as date) as month, count(*) as n
from orders group by 1 order by 1 desc limit 30""")
def recent_periods(spark, sf):
    o = Tables(spark, sf).orders
    c = o.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.desc("month")).limit(30)


@query("group_mean", f"""
select l_returnflag, round(avg(l_extendedprice), {R}) as mean_price, count(*) as n
from lineitem group by l_returnflag""", headline=True)
def group_mean(spark, sf):
    li = Tables(spark, sf).lineitem
    return stats.drop_null_keys(li, "l_returnflag").groupBy("l_returnflag").agg(
        C.round_half_away(F.avg("l_extendedprice"), R).alias("mean_price"), F.count(F.lit(1)).alias("n"))


@query("topk_group_mean", f"""
select o_custkey, round(avg(o_totalprice), {R}) as mean_price
from orders group by o_custkey order by avg(o_totalprice) desc, o_custkey limit 15""")
def topk_group_mean(spark, sf):
    o = Tables(spark, sf).orders
    g = o.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("m"))
    return g.orderBy(F.desc("m"), F.asc("o_custkey")).limit(15).select(
        "o_custkey", C.round_half_away("m", R).alias("mean_price"))


@query("three_key_mean", f"""
select l_returnflag, l_linestatus, cast(year(l_shipdate) as int) as ship_year,
       round(avg(l_quantity), {R}) as mean_qty
from lineitem group by 1, 2, 3""")
def three_key_mean(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.groupBy("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("ship_year")).agg(
        C.round_half_away(F.avg("l_quantity"), R).alias("mean_qty"))


@query("daily_counts", """
select cast(ts as date) as day, event_type, count(*) as n from events group by 1, 2""", headline=True)
def daily_counts(spark, sf):
    e = Tables(spark, sf).events
    return stats.group_counts(e.select(F.to_date("ts").alias("day"), "event_type"), ["day", "event_type"])


@query("top_sources", """
select lang, source, count(*) as n from documents where source <> '' and lang is not null
group by lang, source order by n desc, lang, source limit 15""")
def top_sources(spark, sf):
    d = Tables(spark, sf).documents.select("lang", "source").where(F.col("source") != "")
    g = stats.group_counts(d, ["lang", "source"])
    return g.orderBy(F.desc("n"), "lang", "source").limit(15)


@query("station_summary", f"""
select event_type, round(avg(value), {R}) as mean_value, max(value) as max_value, min(value) as min_value,
       round(sum(value), {R}) as sum_value
from events group by event_type""")
def station_summary(spark, sf):
    e = Tables(spark, sf).events
    return e.groupBy("event_type").agg(
        C.round_half_away(F.avg("value"), R).alias("mean_value"), F.max("value").alias("max_value"),
        F.min("value").alias("min_value"), C.round_half_away(F.sum("value"), R).alias("sum_value"))


# ------------------------------------------------------------------ profiles

@query("kpi_row", "select count(*) as n_rows, cast(6 as bigint) as n_cols, cast(0 as bigint) as n_nulls from orders")
def kpi_row(spark, sf):
    return stats.kpi_row(Tables(spark, sf).orders)


def _events_with_nulls(spark, sf):
    """events with NULLs derived from the data (the supplied tables hold none)."""
    e = Tables(spark, sf).events
    return e.select(
        "event_id", "ts",
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.when(F.get_json_object("props", "$.k").cast("int") >= 10, F.col("props")).alias("props"),
        "user_id")


_EVENTS_NULLS_SQL = """
(select event_id, ts, case when value >= 5 then value end as value,
        nullif(event_type, 'error') as event_type,
        case when cast(json_extract_string(props, '$.k') as int) >= 10 then props end as props, user_id
 from events)"""


@query("null_summary", f"""
with e as {_EVENTS_NULLS_SQL}, c as (
  select count(*) as n, count(*) filter (where event_id is null) as event_id,
         count(*) filter (where ts is null) as ts, count(*) filter (where value is null) as value,
         count(*) filter (where event_type is null) as event_type,
         count(*) filter (where props is null) as props, count(*) filter (where user_id is null) as user_id
  from e)
select column_name, n_null, round(n_null * 100.0 / nullif(n, 0), {R}) as pct_null from (
  select n, 'event_id' as column_name, event_id as n_null from c union all
  select n, 'ts', ts from c union all select n, 'value', value from c union all
  select n, 'event_type', event_type from c union all select n, 'props', props from c union all
  select n, 'user_id', user_id from c) where n_null > 0""")
def null_summary(spark, sf):
    return stats.null_summary(_events_with_nulls(spark, sf))


_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_numeric", " union all ".join(f"""
select '{c}' as column_name, count({c}) as count, round(avg({c}), {R}) as mean, round(stddev_samp({c}), {R}) as std,
       min({c}) as min, round(quantile_cont({c}, 0.25), {R}) as p25, round(quantile_cont({c}, 0.5), {R}) as p50,
       round(quantile_cont({c}, 0.75), {R}) as p75, max({c}) as max from lineitem""" for c in _LI_NUM), headline=True)
def describe_numeric(spark, sf):
    d = stats.describe_numeric(Tables(spark, sf).lineitem, _LI_NUM)
    return d.select("column_name", "count", *[C.round_half_away(c, R).alias(c) for c in ["mean", "std"]], "min",
                    *[C.round_half_away(c, R).alias(c) for c in ["p25", "p50", "p75"]], "max")


@query("describe_categorical", " union all ".join(f"""
select '{c}' as column_name, sum(f) as count, count(*) as "unique", arg_min({c}, (-f, {c})) as top, max(f) as freq
from (select {c}, count(*) as f from orders where {c} is not null group by {c})""" for c in
                                                  ["o_orderstatus", "o_orderpriority"]).replace("sum(f) as count", "cast(sum(f) as bigint) as count"))
def describe_categorical(spark, sf):
    return stats.describe_categorical(Tables(spark, sf).orders, ["o_orderstatus", "o_orderpriority"])


@query("duplicate_count", """
select cast(coalesce(sum(n - 1), 0) as bigint) as n_duplicates, count(*) filter (where n > 1) as n_groups
from (select user_id, event_type, cast(ts as date) as d, count(*) as n from events group by 1, 2, 3)""")
def duplicate_count(spark, sf):
    e = Tables(spark, sf).events.select("user_id", "event_type", F.to_date("ts").alias("d"))
    return stats.duplicate_count(e)


@query("duplicate_groups", """
select l.l_orderkey, l.l_partkey, l.l_linenumber, g.group_size
from lineitem l join (select l_orderkey, l_partkey, count(*) as group_size from lineitem
                      group by 1, 2 having count(*) > 1) g using (l_orderkey, l_partkey)""")
def duplicate_groups(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    return stats.duplicate_groups(li, ["l_orderkey", "l_partkey"])


# ------------------------------------------------------------------ correlation

def _corr_sql(x, y):
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


@query("pearson_pair", f"""
select round({_corr_sql('l_quantity', 'l_extendedprice')}, {R}) as r,
       count(*) filter (where l_quantity is not null and l_extendedprice is not null) as n from lineitem""")
def pearson_pair(spark, sf):
    p = stats.pearson(Tables(spark, sf).lineitem, "l_quantity", "l_extendedprice")
    return p.select(C.round_half_away("r", R).alias("r"), "n")


@query("pearson_guarded", f"""
with d as (select event_type, cast(ts as date) as day, avg(value) as mean_value, count(*) as n,
                  case when count(*) > 70 then max(value) end as hi from events group by 1, 2)
select event_type, count(*) filter (where mean_value is not null and hi is not null) as n_pairs,
  case when count(*) filter (where mean_value is not null and hi is not null) > 5
       then round({_corr_sql('case when hi is not null then mean_value end', 'hi')}, {R}) end as r,
  case when count(*) filter (where mean_value is not null and hi is not null) > 5 then 'ok' else 'insufficient' end as status
from d group by event_type""")
def pearson_guarded(spark, sf):
    """P21 + A16: drop rows with a NULL in the pair, require more than 5 rows, else 'insufficient'.

    Daily series per event type; the daily maximum is NULL on quiet days (<= 70 events).
    """
    e = Tables(spark, sf).events
    d = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.avg("value").alias("mean_value"), F.when(F.count(F.lit(1)) > 70, F.max("value")).alias("hi"))
    # rows with a NULL in the pair are dropped inside the aggregate (pairwise-complete), so a
    # key whose rows all drop out still reports 'insufficient' instead of disappearing
    complete = F.col("mean_value").isNotNull() & F.col("hi").isNotNull()
    g = d.groupBy("event_type").agg(F.count_if(complete).alias("n_pairs"), safe_corr("mean_value", "hi").alias("r"))
    ok = F.col("n_pairs") > 5
    return g.select("event_type", "n_pairs", F.when(ok, C.round_half_away("r", R)).alias("r"),
                    F.when(ok, "ok").otherwise("insufficient").alias("status"))


@query("corr_matrix", " union all ".join(
    f"select '{a}' as var_x, '{b}' as var_y, round({_corr_sql(a, b)}, {R}) as r from lineitem"
    for a in _LI_NUM for b in _LI_NUM), headline=True)
def corr_matrix(spark, sf):
    m = stats.corr_matrix(Tables(spark, sf).lineitem, _LI_NUM)
    return m.select("var_x", "var_y", C.round_half_away("r", R).alias("r"))


@query("ols_pair", f"""
select round(regr_slope(l_extendedprice, l_quantity), {R}) as slope,
       round(regr_intercept(l_extendedprice, l_quantity), {R}) as intercept,
       round(regr_r2(l_extendedprice, l_quantity), {R}) as r2,
       round({_corr_sql('l_quantity', 'l_extendedprice')}, {R}) as r,
       cast(regr_count(l_extendedprice, l_quantity) as bigint) as n, l_returnflag
from lineitem group by l_returnflag""")
def ols_pair(spark, sf):
    o = stats.ols_pair(Tables(spark, sf).lineitem, "l_quantity", "l_extendedprice", by=["l_returnflag"])
    return o.select(*[C.round_half_away(c, R).alias(c) for c in ["slope", "intercept", "r2", "r"]],
                    F.col("n").cast("bigint").alias("n"), "l_returnflag")


# ------------------------------------------------------------------ one-column statistics

def _round_cols(df, cols):
    return df.select(*[C.round_half_away(c, R).alias(c) if c in cols else F.col(c) for c in df.columns])


_STAT_FLOATS = ["mean", "median", "std", "skew", "kurt"]


@query("column_stats", f"""
select count(l_extendedprice) as n, min(l_extendedprice) as min, max(l_extendedprice) as max,
  round(avg(l_extendedprice), {R}) as mean, round(median(l_extendedprice), {R}) as median,
  (select l_extendedprice from lineitem group by 1 order by count(*) desc, 1 limit 1) as mode,
  round(stddev_samp(l_extendedprice), {R}) as std, round(skewness(l_extendedprice), {R}) as skew,
  round(kurtosis(l_extendedprice), {R}) as kurt
from lineitem""")
def column_stats(spark, sf):
    s = stats.column_stats(Tables(spark, sf).lineitem, "l_extendedprice")
    return _round_cols(s, _STAT_FLOATS)


@query("group_median", f"""
select c_nationkey, round(median(c_acctbal), {R}) as median_acctbal, round(median(c_custkey), {R}) as median_custkey
from customer group by c_nationkey""")
def group_median(spark, sf):
    c = Tables(spark, sf).customer
    a = stats.quantiles(c, "c_acctbal", {"median_acctbal": 0.5}, ["c_nationkey"])
    b = stats.quantiles(c, "c_custkey", {"median_custkey": 0.5}, ["c_nationkey"])
    return a.join(b, "c_nationkey").select("c_nationkey", C.round_half_away("median_acctbal", R).alias("median_acctbal"),
                                           C.round_half_away("median_custkey", R).alias("median_custkey"))


@query("group_profile", f"""
with g as (
  select o_orderstatus, count(*) as n, avg(o_totalprice) as m, median(o_totalprice) as med,
         stddev_samp(o_totalprice) as sd, min(o_totalprice) as mn, max(o_totalprice) as mx,
         skewness(o_totalprice) as sk, kurtosis(o_totalprice) as ku
  from orders group by 1)
select g.o_orderstatus, g.n, round(g.m, {R}) as mean, round(g.med, {R}) as median, round(g.sd, {R}) as std,
       g.mn as min, g.mx as max, round(g.sk, {R}) as skew, round(g.ku, {R}) as kurt,
       round((g.m - b.m) * 100 / nullif(b.m, 0), {R}) as diff_pct
from g cross join (select m from g where o_orderstatus = 'F') b""")
def group_profile(spark, sf):
    """Group statistics plus the mean difference in % against a base group ('F')."""
    o = Tables(spark, sf).orders
    g = o.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean"), F.stddev_samp("o_totalprice").alias("std"),
        F.min("o_totalprice").alias("min"), F.max("o_totalprice").alias("max"),
        stats.skew_sample("o_totalprice").alias("skew"), stats.kurt_sample("o_totalprice").alias("kurt"))
    g = g.join(stats.quantiles(o, "o_totalprice", {"median": 0.5}, ["o_orderstatus"]), "o_orderstatus")
    base = o.where(F.col("o_orderstatus") == "F").agg(F.avg("o_totalprice")).scalar()
    out = g.withColumn("diff_pct", F.try_divide((F.col("mean") - base) * 100, base))
    return _round_cols(out.select("o_orderstatus", "n", "mean", "median", "std", "min", "max", "skew", "kurt", "diff_pct"),
                       _STAT_FLOATS + ["diff_pct"])


@query("price_summary", f"""
select p_type, count(*) as n, cast(trunc(avg(p_retailprice)) as bigint) as mean_price,
       cast(trunc(median(p_retailprice)) as bigint) as median_price, max(p_retailprice) as max_price,
       min(p_retailprice) as min_price, cast(trunc(stddev_samp(p_retailprice)) as bigint) as std_price
from part where p_retailprice > 0 group by p_type""")
def price_summary(spark, sf):
    """Per-keyword price summary; int() truncation toward zero."""
    p = Tables(spark, sf).part.where(F.col("p_retailprice") > 0)
    g = p.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg("p_retailprice").cast("bigint").alias("mean_price"),
        F.max("p_retailprice").alias("max_price"),
        F.min("p_retailprice").alias("min_price"), F.stddev_samp("p_retailprice").cast("bigint").alias("std_price"))
    med = stats.quantiles(p, "p_retailprice", {"median_price": 0.5}, ["p_type"])
    return g.join(med, "p_type").select("p_type", "n", "mean_price", F.col("median_price").cast("bigint"),
                                        "max_price", "min_price", "std_price")


_TREND_SQL = """
(select event_type, day, n, n * 100.0 / max(n) over (partition by event_type) as ratio
 from (select event_type, cast(date_trunc('day', ts) as timestamp) as day, count(*) as n from events group by 1, 2))"""


@query("trend_ratio", f"""
select event_type, day as period, n, round(ratio, {R}) as ratio from {_TREND_SQL}""")
def trend_ratio(spark, sf):
    e = Tables(spark, sf).events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    t = stats.trend_ratio(e, "ts", "event_type", "day")
    return t.select("event_type", F.col("period").cast("timestamp_ntz").alias("period"), "n",
                    C.round_half_away("ratio", R).alias("ratio"))


@query("trend_stats", f"""
select event_type, round(avg(ratio), {R}) as mean, round(median(ratio), {R}) as median,
       round(max(ratio), {R}) as max, round(min(ratio), {R}) as min,
       round(skewness(ratio), {R}) as skew, round(stddev_samp(ratio), {R}) as std
from {_TREND_SQL} group by event_type""")
def trend_stats(spark, sf):
    e = Tables(spark, sf).events
    t = stats.trend_ratio(e, "ts", "event_type", "day")
    g = t.groupBy("event_type").agg(F.avg("ratio").alias("mean"),
                                    F.max("ratio").alias("max"), F.min("ratio").alias("min"),
                                    stats.skew_sample("ratio").alias("skew"), F.stddev_samp("ratio").alias("std"))
    g = g.join(stats.quantiles(t, "ratio", {"median": 0.5}, ["event_type"]), "event_type")
    return _round_cols(g, ["mean", "median", "max", "min", "skew", "std"])


@query("active_day_ratio", f"""
with d as (select cast(ts as date) as day, sum(case when event_type = 'purchase' then value else 0 end) as amount
           from events group by 1)
select round(sum(amount), {R}) as total, count(*) filter (where amount > 0) as active_days, count(*) as n_days,
       round(count(*) filter (where amount > 0) * 100.0 / nullif(count(*), 0), {R}) as active_pct from d""")
def active_day_ratio(spark, sf):
    """Total, days with a positive amount, their share (zero guard)."""
    e = Tables(spark, sf).events
    d = e.groupBy(F.to_date("ts").alias("day")).agg(
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)).alias("amount"))
    return d.agg(C.round_half_away(F.sum("amount"), R).alias("total"), F.count_if(F.col("amount") > 0).alias("active_days"),
                 F.count(F.lit(1)).alias("n_days"),
                 C.round_half_away(safe_ratio(F.count_if(F.col("amount") > 0) * 100.0, F.count(F.lit(1))), R).alias("active_pct"))


@query("iqr_cv", f"""
select l_returnflag, round(quantile_cont(l_extendedprice, 0.25), {R}) as q1,
       round(quantile_cont(l_extendedprice, 0.75), {R}) as q3,
       round(quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25), {R}) as iqr,
       round(stddev_samp(l_extendedprice) / nullif(abs(avg(l_extendedprice)), 0), {R}) as cv
from lineitem group by l_returnflag""")
def iqr_cv(spark, sf):
    q = stats.quartile_spread(Tables(spark, sf).lineitem, "l_extendedprice", by=["l_returnflag"])
    return q.select("l_returnflag", *[C.round_half_away(c, R).alias(c) for c in ["q1", "q3", "iqr", "cv"]])


@query("skew_guarded", f"""
select l_orderkey, count(*) as n, round(coalesce(case when count(*) >= 3 then skewness(l_quantity) end, 0), {R}) as skew
from lineitem group by l_orderkey""")
def skew_guarded(spark, sf):
    """A35 per order: many groups have n < 3 or constant values, so both guards fire."""
    li = Tables(spark, sf).lineitem
    return li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"),
                                        C.round_half_away(C.skew_guarded("l_quantity"), R).alias("skew"))


@query("kurt_guarded", f"""
with c as (select l_orderkey, l_extendedprice - avg(l_extendedprice) over (partition by l_orderkey) as x from lineitem),
m as (select l_orderkey, count(*) as n, avg(x ** 2) as m2, avg(x ** 4) as m4, count(*)::double as k from c group by 1)
select l_orderkey, n, round(case when n < 4 or m2 = 0 then 0 else (k - 1) * ((k + 1) * (m4 / (m2 * m2) - 3) + 6) / ((k - 2) * (k - 3)) end, {R}) as kurt
from m""")
def kurt_guarded(spark, sf):
    """A36 per order: many groups have n < 4, so the guard fires."""
    li = Tables(spark, sf).lineitem
    return li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"),
                                        C.round_half_away(C.kurt_guarded("l_extendedprice"), R).alias("kurt"))


# ------------------------------------------------------------------ histogram / box / density

_HIST_SQL = """
with v as (select l_extendedprice as x from lineitem where l_extendedprice is not null),
b as (select min(x) as lo, max(x) as hi from v),
c as (select least(coalesce(floor((x - lo) * 20 / nullif(hi - lo, 0)) + 1, 1), 20)::int as bin, count(*) as n
      from v cross join b group by 1)
select s.bin::int as bin, round(lo + (s.bin - 1) * (hi - lo) / 20, {R}) as bin_lo, round(lo + s.bin * (hi - lo) / 20, {R}) as bin_hi,
       coalesce(c.n, 0) as n
from b cross join (select unnest(range(1, 21)) as bin) s left join c on c.bin = s.bin
""".format(R=R)


@query("histogram", _HIST_SQL)
def histogram(spark, sf):
    h = stats.histogram(Tables(spark, sf).lineitem, "l_extendedprice", 20)
    return h.select("bin", C.round_half_away("bin_lo", R).alias("bin_lo"), C.round_half_away("bin_hi", R).alias("bin_hi"), "n")


@query("box_stats", f"""
with q as (select l_returnflag, quantile_cont(l_extendedprice, 0.25) as q1, quantile_cont(l_extendedprice, 0.5) as median,
                  quantile_cont(l_extendedprice, 0.75) as q3 from lineitem group by 1),
f as (select *, q1 - 1.5 * (q3 - q1) as lo_fence, q3 + 1.5 * (q3 - q1) as hi_fence from q)
select f.l_returnflag, round(q1, {R}) as q1, round(median, {R}) as median, round(q3, {R}) as q3,
       round(lo_fence, 6) as lo_fence, round(hi_fence, 6) as hi_fence,
       min(case when l_extendedprice >= lo_fence then l_extendedprice end) as whisker_lo,
       max(case when l_extendedprice <= hi_fence then l_extendedprice end) as whisker_hi,
       count(*) filter (where l_extendedprice < lo_fence or l_extendedprice > hi_fence) as n_outliers
from lineitem l join f using (l_returnflag) group by all""")
def box_stats(spark, sf):
    b = stats.box_stats(Tables(spark, sf).lineitem, "l_extendedprice", ["l_returnflag"])
    # fences carry five exact decimals (prices x quarter steps x 1.5): rounded at 6 so no tie can split engines
    b = b.withColumn("lo_fence", C.round_half_away("lo_fence", 6)).withColumn("hi_fence", C.round_half_away("hi_fence", 6))
    return _round_cols(b, ["q1", "median", "q3"])


@query("box_outliers", """
with q as (select l_returnflag, quantile_cont(l_extendedprice, 0.25) as q1, quantile_cont(l_extendedprice, 0.75) as q3
           from lineitem group by 1)
select l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_extendedprice from lineitem l join q using (l_returnflag)
where l_extendedprice < q1 - 1.5 * (q3 - q1) or l_extendedprice > q3 + 1.5 * (q3 - q1)""")
def box_outliers(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return stats.box_outliers(li, "l_extendedprice", ["l_returnflag"])


_KDE_SQL = """
with v as (select o_totalprice as x from orders where o_totalprice is not null),
s as (select min(x) as lo, max(x) as hi, count(x) as n, stddev_samp(x) * pow(count(x), -0.2) as bw from v),
g as (select g, lo + g * (hi - lo) / 63 as gx, n, bw from s cross join (select unnest(range(0, 64)) as g))
select g::int as g, round(gx, 4) as x,
       round(sum(exp(-0.5 * ((gx - x) / bw) * ((gx - x) / bw))) / (n * bw * sqrt(2 * pi())), 12) as density
from g cross join v group by g, gx, n, bw"""


@query("kde_grid", _KDE_SQL)
def kde_grid(spark, sf):
    k = stats.kde_grid(Tables(spark, sf).orders, "o_totalprice", n_grid=64)
    return k.select("g", C.round_half_away("x", 4).alias("x"), C.round_half_away("density", 12).alias("density"))


# ------------------------------------------------------------------ misc aggregate reports

@query("rollup_counts", """
select r_name, n_name, count(*) as n, cast(grouping(r_name, n_name) as int) as level_id
from supplier s join nation n on s.s_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey
group by rollup (r_name, n_name)""")
def rollup_counts(spark, sf):
    t = Tables(spark, sf)
    nat = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    reg = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    s = dimension_join(dimension_join(t.supplier.select("s_nationkey"), nat, "s_nationkey", "inner"),
                       reg, "n_regionkey", "inner")
    from sparkpanel.operators.reshape import hierarchical_counts
    return hierarchical_counts(s, ["r_name", "n_name"]).select("r_name", "n_name", "n", F.col("level_id").cast("int"))


@query("direction_counts", """
with a as (select ((l_extendedprice % 360) + 360) % 360 as deg from lineitem)
select (['N','NNE','NE','ENE','E','ESE','SE','SSE','S','SSW','SW','WSW','W','WNW','NW','NNW'])
         [cast(floor((((deg + 11.25) % 360) + 360) % 360 / 22.5) as int) + 1] as direction, count(*) as n
from a group by 1""")
def direction_counts(spark, sf):
    from sparkpanel.functions.columns import degree_to_point
    li = Tables(spark, sf).lineitem
    d = li.select(degree_to_point(F.pmod(F.col("l_extendedprice"), F.lit(360.0))).alias("direction"))
    return d.groupBy("direction").agg(F.count(F.lit(1)).alias("n"))


@query("dedup_rule_compare", """
select count(distinct l_orderkey) as by_order, count(distinct (l_orderkey, l_partkey)) as by_order_part,
       count(distinct (l_partkey, l_suppkey)) as by_part_supp, count(distinct (l_orderkey, l_linenumber)) as by_order_line
from lineitem where l_returnflag = 'R'""")
def dedup_rule_compare(spark, sf):
    """Store count of one brand under four dedup-key choices, one aggregation."""
    li = Tables(spark, sf).lineitem.where(F.col("l_returnflag") == "R")
    return li.agg(F.count_distinct("l_orderkey").alias("by_order"),
                  F.count_distinct("l_orderkey", "l_partkey").alias("by_order_part"),
                  F.count_distinct("l_partkey", "l_suppkey").alias("by_part_supp"),
                  F.count_distinct("l_orderkey", "l_linenumber").alias("by_order_line"))


@query("unmatched_names", """
select distinct p_name from part where not regexp_matches(coalesce(p_name, ''), '(?i)widget|gear')
order by p_name limit 20""")
def unmatched_names(spark, sf):
    p = Tables(spark, sf).part
    return p.where(~F.coalesce(F.col("p_name"), F.lit("")).rlike("(?i)widget|gear")).select("p_name") \
        .distinct().orderBy("p_name").limit(20)


@query("daily_volume", """
select cast(l_shipdate as date) as day, round(sum(l_quantity) / 1000, 1) as volume_k
from lineitem l join part p on l.l_partkey = p.p_partkey where contains(p.p_name, 'widget') group by 1""")
def daily_volume(spark, sf):
    t = Tables(spark, sf)
    parts = t.part.where(F.col("p_name").contains("widget")).select(F.col("p_partkey").alias("l_partkey"))
    li = t.lineitem.select("l_partkey", "l_shipdate", "l_quantity").join(parts, "l_partkey", "left_semi")
    return li.groupBy(F.to_date("l_shipdate").alias("day")).agg(
        C.round_half_away(F.sum("l_quantity") / 1000, 1).alias("volume_k"))


@query("best_reliable_category", f"""
with c as (select c.c_nationkey, count(*) as total, avg(case when o_orderstatus = 'F' then 1.0 else 0.0 end) as rate
           from orders o join customer c on o.o_custkey = c.c_custkey group by 1),
e as (select * from c where total >= 0.02 * (select sum(total) from c))
select c_nationkey, total, round(rate, {R}) as rate from e order by rate desc, c_nationkey limit 1""")
def best_reliable_category(spark, sf):
    """Best rate among categories holding at least 2 % of all rows."""
    t = Tables(spark, sf)
    j = t.orders.select("o_custkey", "o_orderstatus").join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    c = j.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("total"),
                                     F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("rate"))
    e = c.where(F.col("total") >= 0.02 * j.agg(F.count(F.lit(1))).scalar())
    return e.orderBy(F.desc("rate"), "c_nationkey").limit(1).select("c_nationkey", "total", C.round_half_away("rate", R).alias("rate"))


@query("tier_share", f"""
with t as (select case when c_acctbal >= 5000 then 'high' when c_acctbal >= 1000 then 'mid' else 'low' end as tier
           from customer)
select tier, count(*) as n, round(count(*) * 100.0 / sum(count(*)) over (), {R}) as share_pct from t group by tier""")
def tier_share(spark, sf):
    """Tiers by threshold and their share of rows."""
    c = Tables(spark, sf).customer
    tier = F.when(F.col("c_acctbal") >= 5000, "high").when(F.col("c_acctbal") >= 1000, "mid").otherwise("low")
    g = c.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("n"))
    tot = c.agg(F.count(F.lit(1))).scalar()
    return g.select("tier", "n", C.round_half_away(F.col("n") * 100.0 / tot, R).alias("share_pct"))


@query("unified_metrics", f"""
select 'events' as source, count(*) as volume, round(avg(value), {R}) as mean_value from events
union all select 'orders', count(*), round(avg(o_totalprice), {R}) from orders
union all select 'documents', count(*), round(avg(n_chars), {R}) from documents""")
def unified_metrics(spark, sf):
    """Per-source volume and mean via unionByName + one groupBy."""
    t = Tables(spark, sf)
    u = (t.events.select(F.lit("events").alias("source"), F.col("value").cast("double").alias("v"))
         .unionByName(t.orders.select(F.lit("orders").alias("source"), F.col("o_totalprice").alias("v")))
         .unionByName(t.documents.select(F.lit("documents").alias("source"), F.col("n_chars").cast("double").alias("v"))))
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("volume"), C.round_half_away(F.avg("v"), R).alias("mean_value"))


@query("distinct_days", """
select count(distinct cast(ts as date)) as n_days, count(distinct user_id) as n_users, count(distinct event_type) as n_types
from events""")
def distinct_days(spark, sf):
    e = Tables(spark, sf).events
    return e.agg(F.count_distinct(F.to_date("ts")).alias("n_days"), F.count_distinct("user_id").alias("n_users"),
                 F.count_distinct("event_type").alias("n_types"))


@query("argmax_row", """
select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 1""")
def argmax_row(spark, sf):
    """Row at the maximum; ties -> smallest key. max_by is a partial aggregate."""
    o = Tables(spark, sf).orders
    r = o.agg(F.max_by(F.struct("o_orderkey", "o_custkey", "o_totalprice"),
                       F.struct(F.col("o_totalprice"), -F.col("o_orderkey"))).alias("r"))
    return r.where(F.col("r").isNotNull()).select("r.*")
