"""Crosstab, pivot, unpivot, set-operation and sort queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.operators import reshape
from sparkpanel.operators.joins import dimension_join
from sparkpanel.functions import columns as C
from sparkpanel.plans.registry import query
from sparkpanel.sources.tables import Tables

R = 4
# Category lists of the supplied tables used as pivot column lists.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]


def _safe(v: str) -> str:
    return "p_" + v.split("-")[0] if v[0].isdigit() else v.lower()


@query("crosstab_margins", """
select coalesce(n_name, 'Total') as n_name, {cols}, count(*) as total
from customer c join nation n on c.c_nationkey = n.n_nationkey
group by rollup (n_name)""".format(cols=", ".join(
    f"count(*) filter (where c_mktsegment = '{s}') as {s.lower()}" for s in SEGMENTS)), headline=True)
def crosstab_margins(spark, sf):
    """Region x brand counts with row and column totals (rollup + fixed-list pivot)."""
    t = Tables(spark, sf)
    nat = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = dimension_join(t.customer.select("c_nationkey", "c_mktsegment"), nat, "c_nationkey", "inner")
    return reshape.crosstab_wide(j, "n_name", "c_mktsegment", SEGMENTS, "Total",
                                 safe_names={s: s.lower() for s in SEGMENTS})


@query("brand_totals", """
select segment, n from (
  unpivot (select {cols} from customer c join nation n on c.c_nationkey = n.n_nationkey)
  on {names} into name segment value n) order by n desc, segment""".format(
    cols=", ".join(f"count(*) filter (where c_mktsegment = '{s}') as {s.lower()}" for s in SEGMENTS),
    names=", ".join(s.lower() for s in SEGMENTS)))
def brand_totals(spark, sf):
    """Brand totals read from the grand-total row of the crosstab, unpivoted and sorted."""
    wide = crosstab_margins(spark, sf)
    total = wide.where(F.col("n_name") == "Total")
    long = total.unpivot([], [s.lower() for s in SEGMENTS], "segment", "n")
    return long.orderBy(F.desc("n"), "segment")


@query("crosstab_row_pct", f"""
select o_orderstatus, o_orderpriority, count(*) as n,
       round(count(*) * 100.0 / sum(count(*)) over (partition by o_orderstatus), {R}) as pct
from orders group by 1, 2""")
def crosstab_row_pct(spark, sf):
    r = reshape.row_percent(Tables(spark, sf).orders, "o_orderstatus", "o_orderpriority")
    return r.select("o_orderstatus", "o_orderpriority", "n", C.round_half_away("pct", R).alias("pct"))


@query("crosstab_combined", """
select coalesce(o_orderpriority, 'ALL') as o_orderpriority, {cnt}, count(*) as total, {pct}
from orders group by rollup (o_orderpriority)""".format(
    cnt=", ".join(f"count(*) filter (where o_orderstatus = '{s}') as n_{s.lower()}" for s in STATUSES),
    pct=", ".join(f"round(count(*) filter (where o_orderstatus = '{s}') * 100.0 / count(*), {R}) as pct_{s.lower()}"
                  for s in STATUSES)))
def crosstab_combined(spark, sf):
    """Counts, total, row percents and an 'ALL' row from rollup (no union)."""
    o = Tables(spark, sf).orders
    o = o.select("o_orderpriority", reshape.listed("o_orderstatus", STATUSES).alias("o_orderstatus"))
    g = o.rollup("o_orderpriority").agg(
        *[F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s.lower()}") for s in STATUSES],
        F.count(F.lit(1)).alias("total"), F.grouping("o_orderpriority").alias("__g"))
    return g.select(F.when(F.col("__g") == 1, F.lit("ALL")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
                    *[f"n_{s.lower()}" for s in STATUSES], "total",
                    *[C.round_half_away(F.col(f"n_{s.lower()}") * 100.0 / F.col("total"), R).alias(f"pct_{s.lower()}") for s in STATUSES])


@query("pivot_items", """
with d as (select cast(o_orderdate as date) as day, o_orderpriority, avg(o_totalprice) as price from orders group by 1, 2)
select day, {cols} from d group by day""".format(cols=", ".join(
    f"round(max(price) filter (where o_orderpriority = '{p}'), {R}) as {_safe(p)}_price" for p in PRIORITIES)))
def pivot_items(spark, sf):
    """Daily price per item, long -> wide with a name suffix; duplicates fail the job."""
    o = Tables(spark, sf).orders
    d = o.groupBy(F.to_date("o_orderdate").alias("day"), "o_orderpriority").agg(F.avg("o_totalprice").alias("price"))
    w = reshape.pivot_unique(d, "day", "o_orderpriority", "price", PRIORITIES)
    return w.select("day", *[C.round_half_away(F.col(f"`{p}`"), R).alias(f"{_safe(p)}_price") for p in PRIORITIES])


@query("topcat_share", f"""
with top as (select p_brand from part group by 1 order by count(*) desc, p_brand limit 15),
c as (select p_type, p_brand, count(*) as n from part where p_brand in (select p_brand from top) group by 1, 2)
select p_type, p_brand, n, round(n * 100.0 / sum(n) over (partition by p_type), {R}) as share_pct from c""")
def topcat_share(spark, sf):
    """Unstack counts, keep the 15 most frequent categories, row share."""
    from sparkpanel.operators.joins import semi_topk

    p = semi_topk(Tables(spark, sf).part, "p_brand", 15)
    r = reshape.row_percent(p, "p_type", "p_brand")
    return r.select("p_type", "p_brand", "n", C.round_half_away("pct", R).alias("share_pct"))


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("unpivot_split", """
select l_orderkey, l_linenumber, substr(measure, 1, 1) as prefix, replace(substr(measure, 3), 'extended', '') as name, value
from (unpivot (select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax from lineitem)
      on l_quantity, l_extendedprice, l_discount, l_tax into name measure value value)""")
def unpivot_split(spark, sf):
    """Melt wide -> long, then split the variable name into two parts."""
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", *_MEASURES)
    m = reshape.unpivot_measures(li, ["l_orderkey", "l_linenumber"], _MEASURES, "measure", "value")
    return m.select("l_orderkey", "l_linenumber", F.substring("measure", 1, 1).alias("prefix"),
                    F.replace(F.substring("measure", 3, 100), F.lit("extended"), F.lit("")).alias("name"), "value")


# ------------------------------------------------------------------ sort / top-k (2.6)

@query("sort_multi", """
select o_orderkey, o_orderpriority, o_totalprice from orders order by o_orderpriority, o_totalprice desc, o_orderkey""")
def sort_multi(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return o.orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@query("topk", """
select p_partkey, p_name, p_retailprice from part order by p_retailprice desc, p_partkey limit 10""")
def topk(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_name", "p_retailprice")
    return p.orderBy(F.desc("p_retailprice"), "p_partkey").limit(10)


@query("first_nonempty", """
select page_id, url from pages where url is not null and url <> '' order by page_id limit 10""")
def first_nonempty(spark, sf):
    """T4: ORDER BY id LIMIT 10 with a non-empty predicate."""
    p = Tables(spark, sf).pages.select("page_id", "url")
    return p.where(F.col("url").isNotNull() & (F.col("url") != "")).orderBy("page_id").limit(10)


# ------------------------------------------------------------------ set operations (2.7)

@query("union_all", """
select o_orderkey, o_orderstatus, 'part1' as part from orders where o_orderdate < timestamp '1998-01-01'
union all select o_orderkey, o_orderstatus, 'part2' from orders where o_orderdate >= timestamp '1998-01-01'""")
def union_all(spark, sf):
    """UNION ALL of same-schema frames (the two halves of orders, by date)."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    a = o.where(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderstatus", F.lit("part1").alias("part"))
    b = o.where(F.col("o_orderdate") >= cut).select("o_orderkey", "o_orderstatus", F.lit("part2").alias("part"))
    return reshape.union_all([a, b])


@query("distinct_rows", "select distinct c_nationkey, c_mktsegment from customer")
def distinct_rows(spark, sf):
    return Tables(spark, sf).customer.select("c_nationkey", "c_mktsegment").distinct()


@query("union_missing_cols", """
select c_custkey as id, c_name as name, c_acctbal as balance, c_mktsegment as segment, cast(null as bigint) as supplier_key
from customer
union all by name select s_name as name, s_acctbal as balance, s_suppkey as supplier_key from supplier""")
def union_missing_cols(spark, sf):
    """U4: union of differently keyed records; missing columns become NULL."""
    t = Tables(spark, sf)
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"),
                          F.col("s_suppkey").alias("supplier_key"))
    return reshape.union_all([c, s], allow_missing=True)
