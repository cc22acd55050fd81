"""Scan / sink queries.

Round-trip queries write an intermediate copy of a supplied table into the
session's shared checkpoint folder (``spark.checkpoint.dir``) and read it back
through the operator under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.operators import preagg, stats
from sparkpanel.functions import columns as C
from sparkpanel.plans.registry import query
from sparkpanel.session import scratch_path
from sparkpanel.sources import files, formats
from sparkpanel.sources.tables import Tables

R = 4


@query("scan_csv_roundtrip", "select r_regionkey, r_name from region")
def scan_csv_roundtrip(spark, sf):
    """Region -> CSV (header) -> read back with an explicit schema."""
    out = scratch_path(spark, "region-csv")
    files.write_csv(Tables(spark, sf).region, out)
    return files.read_csv(spark, out, "r_regionkey int, r_name string")


@query("multi_file_match_counts", """
select o_orderpriority as source, count(*) as n_rows, count(*) filter (where regexp_matches(o_orderstatus, '(?i)f')) as n_match
from orders group by 1""")
def multi_file_match_counts(spark, sf):
    """Many CSV files; skip own output and files lacking the column; match count per file.

    orders is written as one CSV folder per priority, plus a file without the
    status column and a previous result file that must both be skipped.
    """
    base = scratch_path(spark, "orders-parts")
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    o.write.mode("overwrite").option("header", True).partitionBy("o_orderpriority").csv(base)
    Tables(spark, sf).region.coalesce(1).write.option("header", True).csv(f"{base}/no_status_column")
    spark.range(1).select(F.lit("x").alias("o_orderstatus")).coalesce(1).write.option("header", True).csv(f"{base}/result_out")
    df = files.read_csv_files_with_column(spark, base, "o_orderstatus", "o_orderkey long, o_orderstatus string",
                                          skip_names=("/result_out/",), suffix=".csv")
    df = df.withColumn("source", F.regexp_extract("source_path", "o_orderpriority=([^/]+)/", 1))
    src = F.replace(F.col("source"), F.lit("%20"), F.lit(" "))
    return df.groupBy(src.alias("source")).agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.count_if(F.coalesce(F.col("o_orderstatus"), F.lit("")).rlike("(?i)f")).alias("n_match"))


@query("merge_part_files", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def merge_part_files(spark, sf):
    """S3: numbered page files concatenated with one header; missing pages are tolerated.

    supplier is written in one job as page=1..4 folders; the merge asks for pages
    0..5, so two requested pages do not exist.
    """
    base = scratch_path(spark, "supplier-pages")
    s = Tables(spark, sf).supplier.withColumn("page", (F.col("s_nationkey") / 7).cast("int") + 1)
    s.write.mode("overwrite").option("header", True).partitionBy("page").csv(base)
    return files.merge_part_files(spark, base + "/page={page}", range(0, 6),
                                  "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")


@query("parquet_file_stats")
def parquet_file_stats(spark, sf):
    """Rows, columns, row groups, format version and size of every file of a table, by its footer (read by tasks)."""
    f = files.parquet_footers(spark, f"{sf.rstrip('/')}/lineitem.parquet")
    return f.withColumn("path", F.substring_index("path", "/", -1))


@query("parquet_rows_by_file", """
select l_returnflag, count(*) as num_rows, cast(3 as bigint) as num_columns, true as sizes_known from lineitem group by 1""")
def parquet_rows_by_file(spark, sf):
    """The footers of a table written in folders by key, added up per folder."""
    out = scratch_path(spark, "by-flag")
    t = Tables(spark, sf).lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    t.write.partitionBy("l_returnflag").parquet(out)
    f = files.parquet_footers(spark, out)
    flag = F.regexp_extract("path", "/l_returnflag=([^/]*)/", 1)
    return f.groupBy(flag.alias("l_returnflag")).agg(F.sum("num_rows").alias("num_rows"), F.max("num_columns").alias("num_columns"),
                                                     ((F.min("size_bytes") > 0) & (F.min("num_row_groups") > 0)).alias("sizes_known"))


@query("zipped_csv", """
select s_suppkey, s_name, s_nationkey, case when s_nationkey = 3 then null else s_acctbal end as s_acctbal from supplier""")
def zipped_csv(spark, sf):
    """Suppliers written to zip archives of several CSV members each, and read back member by member."""
    out = scratch_path(spark, "archives")
    s = Tables(spark, sf).supplier.select("s_suppkey", "s_name", "s_nationkey", F.when(F.col("s_nationkey") != 3, F.col("s_acctbal")).alias("s_acctbal"))
    files.write_zipped_csv(s.repartition(3, "s_suppkey"), out, rows_per_member=40)
    return files.read_zipped_csv(spark, out, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")


@query("code_sheet_join", """
select p_type as type, count(*) as n, round(sum(l_quantity), 4) as quantity from lineitem join part on l_partkey = p_partkey
where p_size <= 25 group by 1 union all select null, count(*), round(sum(l_quantity), 4) from lineitem left join part on l_partkey = p_partkey and p_size <= 25
where p_partkey is null having count(*) > 0""")
def code_sheet_join(spark, sf):
    """A code mapping landed in workbooks, read by the registered data source and joined to the facts."""
    out, t = scratch_path(spark, "sheets"), Tables(spark, sf)
    codes = t.part.where("p_size <= 25").select(F.col("p_type").alias("Type"), F.col("p_partkey").alias("Code"))
    formats.write_code_sheets(codes.repartition(3, "Code"), out)
    mapping = files.read_source(spark, "code_sheet", out, schema="code long, type string")
    j = t.lineitem.select("l_partkey", "l_quantity").join(mapping, F.col("l_partkey") == F.col("code"), "left")
    return j.groupBy("type").agg(F.count(F.lit(1)).alias("n"), C.round_half_away(F.sum("l_quantity"), 4).alias("quantity"))


@query("feature_names", """
select s_suppkey as code, s_name as name, [s_nationkey, s_suppkey % 90] as point from supplier""")
def feature_names(spark, sf):
    """Suppliers as features of JSON documents, read back by byte ranges of 4 kB."""
    out = scratch_path(spark, "collections")
    s = Tables(spark, sf).supplier
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.col("s_name").alias("name"), F.col("s_suppkey").alias("code")).alias("properties"),
                                 F.struct(F.lit("Point").alias("type"), F.array("s_nationkey", (F.col("s_suppkey") % 90).cast("int")).alias("coordinates")).alias("geometry")))
    docs = s.select(F.floor(F.col("s_suppkey") / 200).alias("doc"), feature.alias("f")).groupBy("doc").agg(F.array_join(F.collect_list("f"), ",").alias("fs"))
    docs.select("doc", F.concat(F.lit('{"type":"FeatureCollection","features":['), "fs", F.lit("]}"))).write.partitionBy("doc").text(out)
    f = formats.feature_collection(spark, out, range_bytes=4096, suffix=".txt")
    parsed = F.from_json("feature", "struct<properties: struct<name: string, code: long>, geometry: struct<coordinates: array<int>>>")
    return f.select(parsed.alias("f")).select("f.properties.code", "f.properties.name", F.col("f.geometry.coordinates").alias("point"))


@query("narrowed_types", """
select n_name, cast(n_nationkey as tinyint) as n_nationkey, cast(n_regionkey as tinyint) as n_regionkey from nation""")
def narrowed_types(spark, sf):
    """Whole-number columns narrowed to the smallest type before the Parquet sink, read back."""
    out = scratch_path(spark, "narrow")
    files.write_parquet(Tables(spark, sf).nation.select("n_name", "n_nationkey", "n_regionkey"), out, narrow=True)
    return spark.read.parquet(out)


@query("typed_insert", """
select p_partkey, p_name, case when p_size >= 40 then null else p_size end as p_size, p_retailprice from part
union all select p_partkey + 1000000, p_name, null, null from part where p_size < 10""")
def typed_insert(spark, sf):
    """Records of text fields appended to a typed table in two inserts; unparsable sizes become NULL."""
    out = scratch_path(spark, "products")
    p = Tables(spark, sf).part
    size = F.when(F.col("p_size") >= 40, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    rows = p.select(F.col("p_partkey").cast("string"), "p_name", size.alias("p_size"), F.col("p_retailprice").cast("string"))
    schema = "p_partkey long, p_name string, p_size int, p_retailprice double"
    files.typed_append(rows, out, schema)
    more = p.where("p_size < 10").select((F.col("p_partkey") + 1000000).cast("string").alias("p_partkey"), "p_name")
    files.typed_append(more, out, schema)
    return spark.read.parquet(out)


def _preagg(spark, sf):
    e = Tables(spark, sf).events
    x = e.select(F.hour("ts").alias("hour"), "event_type", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    return x.groupBy("hour", "event_type").agg(
        C.round_half_away(F.sum("value"), R).alias("value_sum"), C.round_half_away(F.sum("k"), R).alias("k_sum"),
        F.count("value").alias("value_n"), C.round_half_away(F.avg("value"), R).alias("value_mean"),
        C.round_half_away(F.avg("k"), R).alias("k_mean"))


_PREAGG_SQL = f"""
select cast(hour(ts) as int) as hour, event_type, round(sum(value), {R}) as value_sum,
       round(sum(cast(json_extract_string(props, '$.k') as double)), {R}) as k_sum, count(value) as value_n,
       round(avg(value), {R}) as value_mean, round(avg(cast(json_extract_string(props, '$.k') as double)), {R}) as k_mean
from events group by 1, 2"""


@query("preagg_hour_region", _PREAGG_SQL, headline=True)
def preagg_hour_region(spark, sf):
    """Hour x region sum and mean in ONE pass (sum + count kept so means roll up)."""
    return _preagg(spark, sf)


@query("preagg_sketches", f"""
select event_type, count(value) as n, round(avg(value), {R}) as mean, count(distinct user_id) as exact_distinct,
       round(quantile_cont(value, 0.5), {R}) as exact_p50, round(quantile_cont(value, 0.95), {R}) as exact_p95,
       true as p50_kept, true as p95_kept, true as distinct_kept, true as direct_kept from events group by 1""")
def preagg_sketches(spark, sf):
    """Quantile and distinct sketches stored per hour and event type, merged across the hours: the
    exact values, and whether the estimates keep their bounds, merged and made directly."""
    out, probs = scratch_path(spark, "sketches"), {"p50": 0.5, "p95": 0.95}
    e = Tables(spark, sf).events.select(F.hour("ts").alias("hour"), "event_type", "value", "user_id")
    files.write_parquet(preagg.sketched_cells(e, ["hour", "event_type"], "value", "user_id"), out, partition_by=["hour"])
    merged = preagg.estimates(preagg.roll_up(spark.read.parquet(out), ["event_type"]), probs)
    direct = preagg.estimates(preagg.sketched_cells(e, ["event_type"], "value", "user_id"), {"d50": 0.5, "d95": 0.95}) \
        .select("event_type", "d50", "d95", F.col("n_distinct").alias("d_distinct"))
    both = merged.join(direct, "event_type")
    exact = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact_distinct"))
    q = stats.quantiles(e, "value", {f"exact_{n}": p for n, p in probs.items()}, by=["event_type"])
    ranks = preagg.rank_of(e, ["event_type"], "value", both, ["p50", "p95", "d50", "d95"])
    d = both.join(exact, "event_type").join(q, "event_type").join(ranks, "event_type")
    near = lambda c: F.abs(F.col(c) - F.col("exact_distinct")) <= F.col("exact_distinct") * preagg.DISTINCT_ERROR
    return d.select("event_type", "n", C.round_half_away("mean", R).alias("mean"), "exact_distinct",
                    *[C.round_half_away(c, R).alias(c) for c in ("exact_p50", "exact_p95")],
                    preagg.keeps_rank("p50", 0.5).alias("p50_kept"), preagg.keeps_rank("p95", 0.95).alias("p95_kept"), near("n_distinct").alias("distinct_kept"),
                    (preagg.keeps_rank("d50", 0.5) & preagg.keeps_rank("d95", 0.95) & near("d_distinct")).alias("direct_kept"))


@query("preagg_lookup", f"select * exclude (hour) from ({_PREAGG_SQL}) where hour = 7")
def preagg_lookup(spark, sf):
    """S12 + S13: the pre-aggregate saved partitioned by hour, then a parameterised, pruned lookup."""
    out = scratch_path(spark, "preagg")
    files.write_parquet(_preagg(spark, sf), out, partition_by=["hour"])
    return files.lookup_partition(spark, out, "hour", 7).drop("hour")


@query("time_bounds", """
select count(*) as n_rows, cast(6 as bigint) as n_cols, min(ts) as first_ts, max(ts) as last_ts,
       cast(min(ts) as date) as first_day, cast(max(ts) as date) as last_day from events""")
def time_bounds(spark, sf):
    """KPI row from metadata + one aggregate (rows, columns, time bounds)."""
    e = Tables(spark, sf).events
    return e.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(e.columns)).cast("bigint").alias("n_cols"),
                 F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                 F.to_date(F.min("ts")).alias("first_day"), F.to_date(F.max("ts")).alias("last_day"))


@query("value_counts_nulls", """
select nullif(event_type, 'error') as event_type, count(*) as n from events group by 1""")
def value_counts_nulls(spark, sf):
    """A1 with ``keep_nulls=True``: the NULL key is its own group (D1 option)."""
    e = Tables(spark, sf).events.select(F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"))
    return stats.value_counts(e, "event_type", keep_nulls=True)
