"""Window and daily-panel queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.functions.columns import safe_corr
from sparkpanel.operators import panel
from sparkpanel.functions import columns as C
from sparkpanel.plans.registry import query
from sparkpanel.sources.tables import Tables

R = 4


def _events_daily(spark, sf):
    e = Tables(spark, sf).events
    return panel.daily(e, "ts", ["event_type"], [F.avg("value").alias("mean_value"), F.max("value").alias("max_value"),
                                                 F.sum("value").alias("sum_value"), F.count(F.lit(1)).alias("n")])


_EV_DAILY_SQL = """(select event_type, cast(ts as date) as day, avg(value) as mean_value, max(value) as max_value,
  sum(value) as sum_value, count(*) as n from events group by 1, 2)"""


@query("rolling30", f"""
select event_type, day,
  round(sum(sum_value) over w, {R}) as sum_value_sum30, round(avg(sum_value) over w, {R}) as sum_value_avg30,
  round(sum(mean_value) over w, {R}) as mean_value_sum30, round(avg(mean_value) over w, {R}) as mean_value_avg30,
  cast(sum(n) over w as bigint) as n_sum30
from {_EV_DAILY_SQL} d
window w as (partition by event_type order by day rows between 29 preceding and current row)""", headline=True)
def rolling30(spark, sf):
    """30-row trailing sum/mean per series, min_periods=1."""
    d = _events_daily(spark, sf)
    r = panel.rolling(d, ["event_type"], "day", ["sum_value", "mean_value"], 30)
    r = panel.rolling(r, ["event_type"], "day", ["n"], 30, fns=("sum",))
    return r.select("event_type", "day", *[C.round_half_away(c, R).alias(c) for c in
                                           ["sum_value_sum30", "sum_value_avg30", "mean_value_sum30", "mean_value_avg30"]],
                    F.col("n_sum30").cast("bigint"))


_SPARSE_SQL = """
with d as (select o_orderpriority, cast(o_orderdate as date) as day, {price} as price from orders group by 1, 2),
s as (select o_orderpriority, unnest(generate_series(min(day), max(day), interval 1 day))::date as day from d group by 1),
p as (select s.o_orderpriority, s.day, d.price from s left join d using (o_orderpriority, day))"""


_AVG_PRICE = "avg(o_totalprice)"
# integer cents: interpolation arithmetic is then identical in every IEEE engine
_CENTS = "cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint)"


def _sparse_panel(spark, sf, cents: bool = False):
    o = Tables(spark, sf).orders
    agg = (F.sum(C.round_half_away(F.col("o_totalprice") * 100).cast("bigint")) if cents else F.avg("o_totalprice")).alias("price")
    d = panel.daily(o, "o_orderdate", ["o_orderpriority"], [agg])
    return panel.on_spine(d, "day", ["o_orderpriority"])


@query("date_spine", """
with d as (select o_orderpriority, cast(o_orderdate as date) as day from orders group by 1, 2)
select o_orderpriority, count(*) as n_days, min(day) as first_day, max(day) as last_day from (
  select o_orderpriority, unnest(generate_series(min(day), max(day), interval 1 day))::date as day from d group by 1)
group by 1""")
def date_spine(spark, sf):
    o = Tables(spark, sf).orders
    d = panel.daily(o, "o_orderdate", ["o_orderpriority"], [F.count(F.lit(1)).alias("n")])
    s = panel.date_spine(d, "day", ["o_orderpriority"])
    return s.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_days"), F.min("day").alias("first_day"),
                                            F.max("day").alias("last_day"))


@query("ffill_bfill", _SPARSE_SQL.format(price=_AVG_PRICE) + f"""
select o_orderpriority, day, round(price, {R}) as price,
  round(coalesce(last_value(price ignore nulls) over (partition by o_orderpriority order by day rows between unbounded preceding and current row),
                 first_value(price ignore nulls) over (partition by o_orderpriority order by day rows between current row and unbounded following)), {R}) as price_filled
from p""")
def ffill_bfill(spark, sf):
    p = panel.ffill_bfill(_sparse_panel(spark, sf), ["o_orderpriority"], "day", "price", "price_filled")
    return p.select("o_orderpriority", "day", C.round_half_away("price", R).alias("price"), C.round_half_away("price_filled", R).alias("price_filled"))


@query("interpolate_linear", _SPARSE_SQL.format(price=_CENTS) + f""",
r as (select *, row_number() over (partition by o_orderpriority order by day) as rn from p),
k as (select *,
  last_value(price ignore nulls) over (partition by o_orderpriority order by day rows between unbounded preceding and current row) as pv,
  last_value(case when price is not null then rn end ignore nulls) over (partition by o_orderpriority order by day rows between unbounded preceding and current row) as pr,
  first_value(price ignore nulls) over (partition by o_orderpriority order by day rows between current row and unbounded following) as nv,
  first_value(case when price is not null then rn end ignore nulls) over (partition by o_orderpriority order by day rows between current row and unbounded following) as nr
  from r)
select o_orderpriority, day, price,
  round(case when pv is null then null when nv is null or nr = pr then pv
             else pv + (nv - pv) * (rn - pr) / (nr - pr) end, {R}) as price_interp
from k""")
def interpolate_linear(spark, sf):
    p = panel.interpolate_linear(_sparse_panel(spark, sf, cents=True), ["o_orderpriority"], "day", "price", "price_interp")
    return p.select("o_orderpriority", "day", "price", C.round_half_away("price_interp", R).alias("price_interp"))


@query("lag_corr", """
with p as (select o_orderpriority as item, cast(o_orderdate as date) as day, avg(o_totalprice) as price from orders group by 1, 2),
q as (select cast(l_shipdate as date) as day, sum(l_quantity) as qty from lineitem group by 1),
j as (select p.item, p.day, p.price, q.qty from p join q using (day)),
l as (select item, price, qty as y0,
        lead(qty, 7) over w as y7, lead(qty, 14) over w as y14, lead(qty, 21) over w as y21
      from j window w as (partition by item order by day))
select item, lag_days, round(coalesce(r, 0), 3) as r from (
  select item, 0 as lag_days, covar_pop(price, y0) / nullif(stddev_pop(price) * stddev_pop(y0), 0) as r from l group by item
  union all select item, 7, covar_pop(case when y7 is not null then price end, y7) /
     nullif(stddev_pop(case when y7 is not null then price end) * stddev_pop(y7), 0) from l group by item
  union all select item, 14, covar_pop(case when y14 is not null then price end, y14) /
     nullif(stddev_pop(case when y14 is not null then price end) * stddev_pop(y14), 0) from l group by item
  union all select item, 21, covar_pop(case when y21 is not null then price end, y21) /
     nullif(stddev_pop(case when y21 is not null then price end) * stddev_pop(y21), 0) from l group by item)""")
def lag_corr(spark, sf):
    """corr(price, qty shifted by -k) per item for k in 0/7/14/21; NULL -> 0, 3 digits.

    Both series are reduced to one row per day first; the lead() window is
    partitioned by item over those daily rows.
    """
    from pyspark.sql import Window

    t = Tables(spark, sf)
    p = panel.daily(t.orders.withColumnRenamed("o_orderpriority", "item"), "o_orderdate", ["item"],
                    [F.avg("o_totalprice").alias("price")])
    q = panel.daily(t.lineitem, "l_shipdate", [], [F.sum("l_quantity").alias("qty")])
    j = p.join(q, "day")
    w = Window.partitionBy("item").orderBy("day")
    lags = [0, 7, 14, 21]
    l = j.select("item", "price", *[F.lead("qty", k).over(w).alias(f"y{k}") if k else F.col("qty").alias("y0") for k in lags])
    g = l.groupBy("item").agg(*[safe_corr("price", f"y{k}").alias(f"r{k}") for k in lags])
    long = g.select("item", F.explode(F.array(*[F.struct(F.lit(k).alias("lag_days"), F.col(f"r{k}").alias("r"))
                                                for k in lags])).alias("s")).select("item", "s.*")
    return long.select("item", "lag_days", C.round_half_away(F.coalesce("r", F.lit(0.0)), 3).alias("r"))


@query("dedup_keep_first", """
select l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice from (
  select *, row_number() over (partition by l_orderkey, l_partkey
                               order by l_linenumber, l_quantity, l_extendedprice) as rn from lineitem) where rn = 1""")
def dedup_keep_first(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return panel.keep_first(li, ["l_orderkey", "l_partkey"], ["l_linenumber"])


@query("last7_array", """
with d as (select o_orderpriority, cast(o_orderdate as date) as day, sum(o_totalprice) as total from orders group by 1, 2),
r as (select *, row_number() over (partition by o_orderpriority order by day desc) as rn from d)
select o_orderpriority, list(round(total, 2) order by day) as last_values from r where rn <= 7 group by 1""")
def last7_array(spark, sf):
    o = Tables(spark, sf).orders
    d = panel.daily(o, "o_orderdate", ["o_orderpriority"], [C.round_half_away(F.sum("o_totalprice"), 2).alias("total")])
    return panel.last_n(d, ["o_orderpriority"], "day", "total", 7)


@query("kpi_last_delta", f"""
with d as (select o_orderpriority, cast(o_orderdate as date) as day, sum(o_totalprice) as total from orders group by 1, 2),
r as (select *, row_number() over (partition by o_orderpriority order by day desc) as rn from d)
select a.o_orderpriority, a.day as last_day, round(a.total, {R}) as last, round(b.total, {R}) as previous,
       round(a.total - b.total, {R}) as change, round((a.total - b.total) * 100 / nullif(b.total, 0), {R}) as change_pct
from r a left join r b on a.o_orderpriority = b.o_orderpriority and b.rn = 2 where a.rn = 1""")
def kpi_last_delta(spark, sf):
    o = Tables(spark, sf).orders
    d = panel.daily(o, "o_orderdate", ["o_orderpriority"], [F.sum("o_totalprice").alias("total")])
    k = panel.last_vs_previous(d, ["o_orderpriority"], "day", "total")
    return k.select("o_orderpriority", "last_day", *[C.round_half_away(c, R).alias(c) for c in ["last", "previous", "change", "change_pct"]])


@query("full_outer_daily", """
with a as (select cast(o_orderdate as date) as day, count(*) as orders_n from orders group by 1),
b as (select cast(ts as date) as day, count(*) as events_n from events group by 1)
select coalesce(a.day, b.day) as day, coalesce(orders_n, 0) as orders_n, coalesce(events_n, 0) as events_n
from a full outer join b on a.day = b.day""")
def full_outer_daily(spark, sf):
    """Two daily series full-outer joined on the day."""
    from sparkpanel.operators.joins import full_outer_fill

    t = Tables(spark, sf)
    a = panel.daily(t.orders, "o_orderdate", [], [F.count(F.lit(1)).alias("orders_n")])
    b = panel.daily(t.events, "ts", [], [F.count(F.lit(1)).alias("events_n")])
    return full_outer_fill(a, b, "day", ["orders_n", "events_n"]).orderBy("day")


@query("media_vs_social_daily", """
with a as (select cast(ts as date) as day, count(*) as media_n from events where event_type = 'view' group by 1),
b as (select cast(ts as date) as day, count(*) as social_n from events where event_type = 'click' group by 1)
select coalesce(a.day, b.day) as day, coalesce(media_n, 0) as media_n, coalesce(social_n, 0) as social_n
from a full outer join b on a.day = b.day""")
def media_vs_social_daily(spark, sf):
    """Two daily counts, full outer + zero fill (an empty side needs no branch)."""
    from sparkpanel.operators.joins import full_outer_fill

    e = Tables(spark, sf).events
    a = panel.daily(e.where(F.col("event_type") == "view"), "ts", [], [F.count(F.lit(1)).alias("media_n")])
    b = panel.daily(e.where(F.col("event_type") == "click"), "ts", [], [F.count(F.lit(1)).alias("social_n")])
    return full_outer_fill(a, b, "day", ["media_n", "social_n"])


def _scored(spark, sf):
    """Fixed score column for curve tests: log10 of document length (ties included)."""
    t = Tables(spark, sf)
    d = t.documents.select("doc_id", C.round_half_away(F.log10(F.col("n_chars") + 1), 1).alias("score"))
    return t.labels.select("doc_id", "quality").join(d, "doc_id")


_SCORED_SQL = """(select l.doc_id, l.quality, round(log10(d.n_chars + 1), 1) as score
  from labels l join documents d using (doc_id))"""


@query("roc_points", f"""
with g as (select score, sum(quality) as pos, sum(1 - quality) as neg from {_SCORED_SQL} group by score),
c as (select score, sum(pos) over w as tp, sum(neg) over w as fp from g
      window w as (order by score desc rows between unbounded preceding and current row))
select score as threshold, cast(tp as bigint) as tp, cast(fp as bigint) as fp,
       round(tp / (select sum(pos) from g), {R}) as tpr, round(fp / (select sum(neg) from g), {R}) as fpr from c""")
def roc_points(spark, sf):
    c = panel.curve_points(_scored(spark, sf), "score", "quality")
    return c.select("threshold", "tp", "fp", C.round_half_away("tpr", R).alias("tpr"), C.round_half_away("fpr", R).alias("fpr"))


@query("pr_points", f"""
with g as (select score, sum(quality) as pos, sum(1 - quality) as neg from {_SCORED_SQL} group by score),
c as (select score, sum(pos) over w as tp, sum(neg) over w as fp from g
      window w as (order by score desc rows between unbounded preceding and current row))
select score as threshold, round(tp / nullif(tp + fp, 0), {R}) as precision,
       round(tp / (select sum(pos) from g), {R}) as recall from c""")
def pr_points(spark, sf):
    c = panel.curve_points(_scored(spark, sf), "score", "quality")
    return c.select("threshold", C.round_half_away("precision", R).alias("precision"), C.round_half_away("tpr", R).alias("recall"))
