"""Report queries that combine several operators (A54, A56, A57, P2, P26, W10, ML5-ML9 invariants)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from sparkpanel.functions import columns as C
from sparkpanel.operators import clean, stats
from sparkpanel.plans.registry import query
from sparkpanel.sources.tables import Tables

R = 4

# ------------------------------------------------------------------ previews and groups

@query("tail_preview", """
select o_orderkey, o_totalprice, o_orderstatus from (select * from orders order by o_orderkey desc limit 5)""")
def tail_preview(spark, sf):
    """The last five rows by key (a top-n on the descending key, shown ascending)."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    return o.orderBy(F.desc("o_orderkey")).limit(5).orderBy("o_orderkey")


@query("duplicate_first_rows", """
with g as (select l_partkey, l_suppkey, count(*) as group_size, min((l_orderkey, l_linenumber)) as f
           from lineitem group by 1, 2 having count(*) > 1)
select l_partkey, l_suppkey, group_size, f[1] as first_order, f[2] as first_line from g""")
def duplicate_first_rows(spark, sf):
    """Of every key that occurs more than once, its size and its first row by (order, line)."""
    li = Tables(spark, sf).lineitem.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    g = li.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("group_size"), F.min(F.struct("l_orderkey", "l_linenumber")).alias("f"))
    return g.where("group_size > 1").select("l_partkey", "l_suppkey", "group_size", F.col("f.l_orderkey").alias("first_order"),
                                            F.col("f.l_linenumber").alias("first_line"))


@query("header_shift_repaired", "select o_orderkey, o_custkey, year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as day from orders")
def header_shift_repaired(spark, sf):
    """Names that slipped by one column are recognised by dates in the hour column and moved back."""
    o = Tables(spark, sf).orders
    day = (F.year("o_orderdate") * 10000 + F.month("o_orderdate") * 100 + F.dayofmonth("o_orderdate")).cast("long")
    right = o.select((F.col("o_orderkey") % 24).alias("hour"), day.alias("day"), "o_orderkey", "o_custkey")
    slipped = right.toDF("idx", "hour", "day", "o_orderkey")  # an index name in front pushed the names to the right
    fixed = clean.repair_header_shift(slipped, "hour")
    return fixed.select("o_orderkey", F.col("_extra").alias("o_custkey"), "day")


# ------------------------------------------------------------------ tiers and shares

@query("top5_share", f"""
with p as (select sum(o_totalprice) as s from orders group by o_custkey)
select round(sum(s) filter (where r <= 5) * 100 / sum(s), {R}) as top5_share_pct, count(*) as n_items
from (select s, row_number() over (order by s desc) as r from p)""")
def top5_share(spark, sf):
    """Share of the five largest customers in all order value."""
    p = Tables(spark, sf).orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"))
    top = p.orderBy(F.desc("s")).limit(5).agg(F.sum("s")).scalar()
    return p.agg(C.round_half_away(top * 100 / F.sum("s"), R).alias("top5_share_pct"), F.count(F.lit(1)).alias("n_items"))


@query("year_share", f"""
select year(o_orderdate)::int as year, count(*) as n, round(count(*) * 100.0 / sum(count(*)) over (), {R}) as share_pct from orders group by 1""")
def year_share(spark, sf):
    """Rows per publication year and their share."""
    o = Tables(spark, sf).orders
    total = o.agg(F.count(F.lit(1))).scalar()
    return o.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n")) \
        .select("year", "n", C.round_half_away(F.col("n") * 100.0 / total, R).alias("share_pct"))


@query("term_share", f"""
select count(*) filter (where contains(lower(p_name), 'widget')) as n_with, count(*) as n,
       round(count(*) filter (where contains(lower(p_name), 'widget')) * 100.0 / count(*), {R}) as share_pct from part""")
def term_share(spark, sf):
    """Share of titles that contain a term."""
    hit = F.count_if(F.lower("p_name").contains("widget"))
    return Tables(spark, sf).part.agg(hit.alias("n_with"), F.count(F.lit(1)).alias("n"),
                                      C.round_half_away(hit * 100.0 / F.count(F.lit(1)), R).alias("share_pct"))


# ------------------------------------------------------------------ unified metrics per keyword

KEYWORDS = ["widget", "gear", "the", "license", "please"]


def _volumes_sql(source: str, text: str) -> str:
    return f"select k, (select count(*) from {source} where contains(lower({text}), k)) as n from kw"


@query("keyword_metrics", f"""
with kw as (select unnest({KEYWORDS}) as k),
a as ({_volumes_sql('part', 'p_name')}), b as ({_volumes_sql('documents', 'text')}),
c as ({_volumes_sql('pages', 'html')}), d as ({_volumes_sql('conversations', 'text')}),
m as (select k, round(avg(p_retailprice), {R}) as mean_price from kw left join part on contains(lower(p_name), k) group by 1)
select k as keyword, a.n as n_products, b.n as n_documents, c.n as n_pages, d.n as n_messages, mean_price,
       a.n + b.n + c.n + d.n as total from a join b using (k) join c using (k) join d using (k) join m using (k)""")
def keyword_metrics(spark, sf):
    """Per keyword the volumes of four sources and the mean product price (one union, one aggregation)."""
    t = Tables(spark, sf)

    def hits(df, source, text, price=None):
        found = F.filter(F.array(*[F.lit(k) for k in KEYWORDS]), lambda k: F.contains(F.lower(F.col(text)), k))
        return df.select(F.explode(found).alias("keyword"), F.lit(source).alias("source"),
                         (F.col(price) if price else F.lit(None)).cast("double").alias("price"))

    u = reduce(lambda a, b: a.unionByName(b), [
        hits(t.part, "products", "p_name", "p_retailprice"), hits(t.documents, "documents", "text"),
        hits(t.pages, "pages", "html"), hits(t.conversations, "messages", "text")])
    n = {s: F.count_if(F.col("source") == s).alias(f"n_{s}") for s in ("products", "documents", "pages", "messages")}
    g = u.groupBy("keyword").agg(*n.values(), F.avg("price").alias("mean_price"), F.count_if(F.col("source").isNotNull()).alias("total"))
    spine = spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in KEYWORDS])).alias("keyword"))
    j = spine.join(g, "keyword", "left")
    return j.select("keyword", *[F.coalesce(f"n_{s}", F.lit(0).cast("long")).alias(f"n_{s}") for s in n],
                    C.round_half_away("mean_price", R).alias("mean_price"), F.coalesce("total", F.lit(0).cast("long")).alias("total"))


# ------------------------------------------------------------------ full data profile

def full_profile(df, n_bins: int = 5):
    """(column_name, metric, value string): every column of a table.

    All columns: rows, nulls, distinct values.  Numbers: mean, std, min, quartiles, max and a
    histogram.  Texts: shortest and longest length and the most frequent value.  Pairs of
    number columns: Pearson r.
    """
    numbers = [f.name for f in df.schema.fields if f.dataType.typeName() in ("short", "integer", "long", "float", "double", "byte")]
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    fix = lambda c: C.round_half_away(c, R).cast("string")
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[F.struct(F.count(F.col(c)).alias("k"), F.count_distinct(c).alias("d")).alias(c) for c in df.columns])
    rows = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("__n"), F.col(c)["k"].alias("k"), F.col(c)["d"].alias("d")) for c in df.columns])))
    parts = [rows.select("column_name", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("string").alias("value")) for m, v in
             (("n_rows", F.col("__n")), ("n_nulls", F.col("__n") - F.col("k")), ("n_distinct", F.col("d")))])))]
    if numbers:
        d = stats.describe_numeric(df, numbers)
        parts.append(d.select("column_name", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), fix(m).alias("value"))
                                                                for m in ("mean", "std", "min", "p25", "p50", "p75", "max")]))))
        r = stats.corr_matrix(df, numbers).where("var_x < var_y")
        parts.append(r.select(F.col("var_x").alias("column_name"), F.concat(F.lit("r_"), F.col("var_y")).alias("metric"), fix("r").alias("value")))
        for c in numbers:
            h = stats.histogram(df, c, n_bins)
            parts.append(h.select(F.lit(c).alias("column_name"), F.concat(F.lit("bin_"), F.col("bin").cast("string")).alias("metric"), F.col("n").cast("string").alias("value")))
    if texts:
        cat = stats.describe_categorical(df, texts)
        parts.append(cat.select("column_name", F.lit("top").alias("metric"), F.col("top").alias("value")))
        size = df.agg(*[F.struct(F.min(F.length(c)).alias("lo"), F.max(F.length(c)).alias("hi")).alias(c) for c in texts])
        parts.append(size.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(m).alias("metric"), F.col(c)[k].cast("string").alias("value"))
                                                    for c in texts for m, k in (("shortest", "lo"), ("longest", "hi"))]))))
    return reduce(lambda a, b: a.unionByName(b), parts)


_NUM, _TXT = ["c_custkey", "c_nationkey", "c_acctbal"], ["c_name", "c_mktsegment"]


def _num_sql(c: str) -> str:
    q = {"mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})", "p25": f"quantile_cont({c}, 0.25)",
         "p50": f"quantile_cont({c}, 0.5)", "p75": f"quantile_cont({c}, 0.75)", "max": f"max({c})"}
    return " union all ".join(f"select '{c}' as column_name, '{m}' as metric, round({e}::double, {R}) as v from customer" for m, e in q.items())


_PROFILE_SQL = " union all ".join(
    [f"select '{c}' as column_name, m as metric, v::double as v, null as s from (select unnest(['n_rows','n_nulls','n_distinct']) as m, "
     f"unnest([count(*), count(*) - count({c}), count(distinct {c})]) as v from customer)" for c in _NUM + _TXT]
    + [f"select column_name, metric, v, null from ({_num_sql(c)})" for c in _NUM]
    + [f"select '{a}', 'r_{b}', round(covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0), {R}), null from customer"
       for a in _NUM for b in _NUM if a < b]
    + [f"select '{c}', 'bin_' || s.b, coalesce(n, 0)::double, null from (select unnest(range(1, 6)) as b) s left join (select least(floor(({c} - lo) * 5 / nullif(hi - lo, 0)) + 1, 5)::int as b, "
       f"count(*) as n from customer, (select min({c})::double as lo, max({c})::double as hi from customer) group by 1) h on s.b = h.b" for c in _NUM]
    + [f"select '{c}', 'top', null, (select {c} from customer where {c} is not null group by 1 order by count(*) desc, 1 limit 1)" for c in _TXT]
    + [f"select '{c}', '{m}', {f}(length({c}))::double, null from customer" for c in _TXT for m, f in (("shortest", "min"), ("longest", "max"))])


@query("full_profile", f"select column_name, metric, v as value, s as text_value from ({_PROFILE_SQL})")
def full_profile_query(spark, sf):
    """The whole customer table, all columns (numbers in value, texts in text_value)."""
    p = full_profile(Tables(spark, sf).customer.select(*_NUM, *_TXT))
    text = F.col("metric") == "top"
    return p.select("column_name", "metric", F.when(~text, F.col("value")).cast("double").alias("value"), F.when(text, F.col("value")).alias("text_value"))
