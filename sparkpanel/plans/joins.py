"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.operators import joins, stats
from sparkpanel.functions import columns as C
from sparkpanel.plans.registry import query
from sparkpanel.sources.tables import Tables

R = 4


@query("left_join_medians", f"""
with m as (select c_nationkey, median(c_acctbal) as med from customer group by 1)
select n.n_nationkey, n.n_name, round(m.med, {R}) as median_acctbal
from nation n left join m on n.n_nationkey = m.c_nationkey""")
def left_join_medians(spark, sf):
    """Left join of a per-group aggregate onto the result table (unmatched rows keep NULL)."""
    t = Tables(spark, sf)
    c = t.customer.withColumnRenamed("c_nationkey", "n_nationkey")
    m = stats.quantiles(c, "c_acctbal", {"med": 0.5}, ["n_nationkey"])
    return t.nation.select("n_nationkey", "n_name").join(m, "n_nationkey", "left").select(
        "n_nationkey", "n_name", C.round_half_away("med", R).alias("median_acctbal"))


@query("code_name_join", """
select c.c_custkey, n.n_name, r.r_name
from customer c
left join nation n on try_cast(try_cast(trim(cast(c.c_nationkey as varchar)) as double) as bigint) = n.n_nationkey
left join region r on n.n_regionkey = r.r_regionkey""", headline=True)
def code_name_join(spark, sf):
    """Fact -> code dimension with key normalisation; bad keys -> NULL (never 0)."""
    t = Tables(spark, sf)
    c = t.customer.select("c_custkey", joins.normalise_code("c_nationkey").alias("__code"))
    nat = t.nation.select(F.col("n_nationkey").cast("bigint").alias("__code"), "n_name", "n_regionkey")
    reg = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    j = joins.dimension_join(c, nat, "__code", "left")
    j = joins.dimension_join(j, reg, "n_regionkey", "left")
    return j.select("c_custkey", "n_name", "r_name")


@query("lookup_with_default", """
select p.p_partkey, coalesce(d.label, 'unlisted') as size_label
from part p left join (select * from (values (1, 'tiny'), (2, 'tiny'), (10, 'small'), (25, 'medium'), (50, 'large'))
                       t(p_size, label)) d on p.p_size = d.p_size""")
def lookup_with_default(spark, sf):
    """Dictionary lookup with a default for keys the dictionary lacks."""
    p = Tables(spark, sf).part.select("p_partkey", "p_size")
    # The lookup dictionary (size -> label); 5 rows, broadcast by construction.
    dim = spark.createDataFrame([(1, "tiny"), (2, "tiny"), (10, "small"), (25, "medium"), (50, "large")],
                                "p_size int, label string")
    return joins.lookup_with_default(p, dim, "p_size", "label", "unlisted", "size_label").select("p_partkey", "size_label")


@query("semi_topk_avg", f"""
with top as (select p_brand from part group by 1 order by count(*) desc, p_brand limit 5)
select p_brand, round(avg(p_retailprice), {R}) as mean_price, count(*) as n
from part where p_brand in (select p_brand from top) group by p_brand""")
def semi_topk_avg(spark, sf):
    """Keep rows whose key is among the k most frequent keys, then aggregate."""
    p = Tables(spark, sf).part
    s = joins.semi_topk(p, "p_brand", 5)
    return s.groupBy("p_brand").agg(C.round_half_away(F.avg("p_retailprice"), R).alias("mean_price"), F.count(F.lit(1)).alias("n"))


@query("unmatched_regions", """
select n.n_nationkey, n.n_name from nation n
where not exists (select 1 from supplier s where s.s_nationkey = n.n_nationkey)""")
def unmatched_regions(spark, sf):
    """Names with no match on the other side (left anti join)."""
    t = Tables(spark, sf)
    s = t.supplier.select(F.col("s_nationkey").alias("n_nationkey"))
    return t.nation.select("n_nationkey", "n_name").join(s, "n_nationkey", "left_anti")


@query("orphan_check", """
select count(*) as n_orphans, min(o_orderkey) as first_orphan from orders o
where not exists (select 1 from customer c where c.c_custkey = o.o_custkey)""")
def orphan_check(spark, sf):
    """Foreign-key check: orders whose customer is missing (left anti)."""
    t = Tables(spark, sf)
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    return o.join(c, "o_custkey", "left_anti").agg(F.count(F.lit(1)).alias("n_orphans"),
                                                   F.min("o_orderkey").alias("first_orphan"))


# The scenario table of the scoring stand-in (name, price factor, size shift).
SCENARIOS = [("base", 1.0, 0), ("heat", 1.15, 5), ("frost", 0.9, -5)]


@query("scenario_cross", f"""
select p.p_partkey, s.name as scenario, round(greatest(900.0, least(1100.0, p.p_retailprice * s.factor)), {R}) as score,
       greatest(1, least(50, p.p_size + s.shift)) as size_adj
from part p, (values {', '.join(f"('{n}', {f}, {d})" for n, f, d in SCENARIOS)}) s(name, factor, shift)""")
def scenario_cross(spark, sf):
    """Every scenario applied to every item.

    The scenario list is a literal array exploded per item row (a generator),
    so no join is planned: rows grow as items x scenarios by definition.
    """
    p = Tables(spark, sf).part
    arr = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(f).alias("factor"), F.lit(d).alias("shift"))
                    for n, f, d in SCENARIOS])
    x = p.select("p_partkey", "p_retailprice", "p_size", F.explode(arr).alias("s"))
    return x.select("p_partkey", F.col("s.name").alias("scenario"),
                    C.round_half_away(F.greatest(F.lit(900.0), F.least(F.lit(1100.0), F.col("p_retailprice") * F.col("s.factor"))), R).alias("score"),
                    F.greatest(F.lit(1), F.least(F.lit(50), F.col("p_size") + F.col("s.shift"))).alias("size_adj"))
