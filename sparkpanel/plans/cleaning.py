"""Projection, filter, cleaning and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.functions import columns as C
from sparkpanel.functions.columns import try_cast
from sparkpanel.operators import clean, documents, tag
from sparkpanel.operators.joins import dimension_join
from sparkpanel.plans.registry import query
from sparkpanel.sources.tables import Tables

R = 4

# Stand-in rule tables for the part names of the test data
# (the store-brand rule sets of the reference are in operators/tag.py).
PART_RULES = [("fastener", ["bolt", "rod"]), ("machine", ["gear", "gizmo", "widget"]),
              ("kitchen", ["plate"]), ("jewel", ["ring"])]
PART_PATTERN = r"(small\s*gear|small_gear|gear|widget|gizmo|hot\s*plate)"
PART_ALIASES = {"smallgear": "GEAR", "gear": "GEAR", "widget": "WIDGET", "gizmo": "GIZMO", "hotplate": "PLATE"}


@query("rename_projection", """
select event_id as id, ts as event_time, user_id as visitor, event_type as action, value as amount from events""")
def rename_projection(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "ts", "user_id", "event_type", "value")
    return clean.rename(e, {"event_id": "id", "ts": "event_time", "user_id": "visitor",
                            "event_type": "action", "value": "amount"})


@query("header_shift_check", """
select 'o_orderkey' as column_name, max(o_orderkey) as max_value, max(o_orderkey) > 10000 as is_shifted from orders""")
def header_shift_check(spark, sf):
    return clean.header_shift_report(Tables(spark, sf).orders, "o_orderkey", threshold=10000)


@query("infer_column_roles", """
with e as (select event_id, user_id, value, hour(ts) as hour, cast(json_extract_string(props, '$.k') as bigint) + 11000000 as area_code
           from events)
select column_name, min_value, max_value, is_integral,
       case when is_integral and min_value >= 0 and max_value <= 23 then 'hour'
            when is_integral and min_value >= 11000000 and max_value <= 12000000 then 'region_code'
            else 'measure' end as role
from (select 'event_id' as column_name, min(event_id)::double as min_value, max(event_id)::double as max_value,
             count(*) filter (where event_id::double <> floor(event_id::double)) = 0 as is_integral from e
      union all select 'user_id', min(user_id)::double, max(user_id)::double, count(*) filter (where user_id::double <> floor(user_id::double)) = 0 from e
      union all select 'value', min(value), max(value), count(*) filter (where value <> floor(value)) = 0 from e
      union all select 'hour', min(hour)::double, max(hour)::double, count(*) filter (where hour::double <> floor(hour::double)) = 0 from e
      union all select 'area_code', min(area_code)::double, max(area_code)::double, count(*) filter (where area_code::double <> floor(area_code::double)) = 0 from e)""")
def infer_column_roles(spark, sf):
    e = Tables(spark, sf).events.select(
        "event_id", "user_id", "value", F.hour("ts").alias("hour"),
        (F.get_json_object("props", "$.k").cast("bigint") + 11_000_000).alias("area_code"))
    return clean.infer_roles(e, ["event_id", "user_id", "value", "hour", "area_code"])


@query("coerce_numeric", """
select event_id, try_cast(json_extract_string(props, '$.k') as int) as k_num,
       try_cast(event_type as double) as type_num, try_cast(props as double) as props_num from events""")
def coerce_numeric(spark, sf):
    """P5: text -> number, NULL on failure (``try_cast``; plain cast raises under ANSI)."""
    e = Tables(spark, sf).events
    return e.select("event_id", try_cast(F.get_json_object("props", "$.k"), "int").alias("k_num"),
                    try_cast("event_type", "double").alias("type_num"),
                    try_cast("props", "double").alias("props_num"))


def _price_text(p, size):
    whole = F.floor(p).cast("bigint")
    text = F.when(whole >= 1000, F.concat((whole / 1000).cast("bigint").cast("string"), F.lit(","),
                                          F.lpad(F.pmod(whole, F.lit(1000)).cast("string"), 3, "0"))) \
        .otherwise(whole.cast("string"))
    return F.when(size < 5, F.lit("")).when(size > 45, F.lit("n/a")).otherwise(text)


@query("clean_money_text", """
with t as (select p_partkey,
  case when p_size < 5 then '' when p_size > 45 then 'n/a'
       when floor(p_retailprice) >= 1000 then cast(cast(floor(p_retailprice) // 1000 as bigint) as varchar) || ','
            || lpad(cast(cast(floor(p_retailprice) as bigint) % 1000 as varchar), 3, '0')
       else cast(cast(floor(p_retailprice) as bigint) as varchar) end as price_text from part)
select p_partkey, price_text, coalesce(try_cast(replace(trim(price_text), ',', '') as bigint), 0) as price from t""")
def clean_money_text(spark, sf):
    """P6: '1,234' -> 1234; blank / non-numeric -> 0."""
    p = Tables(spark, sf).part
    t = p.select("p_partkey", _price_text(F.col("p_retailprice"), F.col("p_size")).alias("price_text"))
    return t.withColumn("price", C.money_text_to_long("price_text"))


@query("filter_in_list", """
select c_custkey, c_mktsegment from customer where c_mktsegment in ('BUILDING', 'MACHINERY')""")
def filter_in_list(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    return clean.filter_in(c, "c_mktsegment", ["BUILDING", "MACHINERY"])


@query("date_range_filter", """
select o_orderkey, o_orderdate from orders
where o_orderdate between timestamp '1996-01-01' and timestamp '1996-03-31'""")
def date_range_filter(spark, sf):
    """P10: sargable range on the raw column, so Parquet row groups are pruned."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    return o.where(F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"),
                                                F.lit("1996-03-31").cast("timestamp_ntz")))


@query("tz_date_filter", """
select event_id, cast(ts + interval 9 hour as date) as local_day from events
where cast(ts + interval 9 hour as date) between date '2024-01-05' and date '2024-01-10'""")
def tz_date_filter(spark, sf):
    """UTC times filtered by their Asia/Seoul calendar date."""
    e = Tables(spark, sf).events
    d = e.select("event_id", clean.local_date(F.col("ts"), "Asia/Seoul").alias("local_day"))
    return d.where(F.col("local_day").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-10").cast("date")))


@query("temporal_holdout", """
select split, count(*) as n from (
  select case when year(o_orderdate) <= 1999 then 'train'
              when year(o_orderdate) = 2001 and month(o_orderdate) in (3, 4, 5, 6) then 'test' end as split
  from orders) where split is not null group by split""")
def temporal_holdout(spark, sf):
    o = Tables(spark, sf).orders
    s = o.select(clean.temporal_split(F.col("o_orderdate"), 1999, 2001, [3, 4, 5, 6]).alias("split"))
    return s.where(F.col("split").isNotNull()).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("composite_key", """
select n.n_nationkey, r.r_name || ' ' || n.n_name as region_key
from nation n left join region r on n.n_regionkey = r.r_regionkey""")
def composite_key(spark, sf):
    """P15: 'province district' key; a NULL part keeps the key NULL."""
    t = Tables(spark, sf)
    reg = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    j = dimension_join(t.nation, reg, "n_regionkey", "left")
    return j.select("n_nationkey", F.concat(F.col("r_name"), F.lit(" "), F.col("n_name")).alias("region_key"))


@query("regex_filter", """
select p_partkey, p_name from part where regexp_matches(coalesce(p_name, ''), '(?i)(widget|gear)')""")
def regex_filter(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_name")
    return clean.regex_match(p, "p_name", "(widget|gear)")


def _rules_sql(col, rules, default):
    parts = []
    for label, subs in rules:
        cond = " or ".join(f"contains(lower(coalesce({col}, '')), '{s}')" for s in subs)
        parts.append(f"when {cond} then '{label}'")
    return f"case {' '.join(parts)} else '{default}' end"


@query("tag_by_rules", f"""
select p_partkey, {_rules_sql('p_name', PART_RULES, 'other')} as tag from part""")
def tag_by_rules(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", tag.tag_by_rules(F.col("p_name"), PART_RULES, "other").alias("tag"))


@query("tag_by_regex_alias", """
select p_partkey, coalesce(case regexp_replace(regexp_extract(lower(coalesce(p_name, '')), '{pat}', 1), '[\\s_]+', '', 'g')
  {whens} end, 'other') as tag from part""".format(
    pat=PART_PATTERN, whens=" ".join(f"when '{k}' then '{v}'" for k, v in PART_ALIASES.items())))
def tag_by_regex_alias(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", tag.tag_by_regex_alias(F.col("p_name"), PART_PATTERN, PART_ALIASES, "other").alias("tag"))


@query("clamp_values", """
select l_orderkey, l_linenumber, greatest(0.02, least(0.08, l_discount)) as discount_clamped from lineitem""")
def clamp_values(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber", C.clamp("l_discount", 0.02, 0.08).alias("discount_clamped"))


@query("unit_repair", """
select p_partkey, case when p_type in ('SMALL', 'ECONOMY') and p_retailprice < 950 then p_retailprice * 10
                       else p_retailprice end as price from part""")
def unit_repair(spark, sf):
    """x10 for selected items under a price floor."""
    p = Tables(spark, sf).part
    return p.select("p_partkey", F.when(F.col("p_type").isin("SMALL", "ECONOMY") & (F.col("p_retailprice") < 950),
                                        F.col("p_retailprice") * 10).otherwise(F.col("p_retailprice")).alias("price"))


_TOKENS_SQL = """
with raw as (select n.n_name || ', ' || cast(n.n_nationkey as varchar) || ', ' || cast(n.n_nationkey + 100 as varchar)
                    || ', ' || lower(r.r_name) || ', ' as token_list
             from nation n join region r on n.n_regionkey = r.r_regionkey),
tok as (select distinct trim(t) as token from raw, unnest(string_split(token_list, ',')) as u(t) where trim(t) <> '')
select distinct tok.token, coalesce(byname.n_nationkey, bycode.n_nationkey) as nation_key,
  case when byname.n_nationkey is not null then 'name' when bycode.n_nationkey is not null then 'code'
       when regexp_matches(tok.token, '^[0-9]{3}$') then 'code3' else 'invalid' end as status
from tok left join nation byname on upper(tok.token) = upper(byname.n_name)
left join nation bycode on try_cast(tok.token as int) = bycode.n_nationkey"""


@query("resolve_tokens", _TOKENS_SQL)
def resolve_tokens(spark, sf):
    """Parse a free-text token list; resolve by name, then by code; dedup.

    The token text is built from nation x region, so the job grows with the data.
    Both lookups are dimension joins (broadcast behind a size check).
    """
    t = Tables(spark, sf)
    reg = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    raw = dimension_join(t.nation, reg, "n_regionkey", "inner").select(
        F.concat_ws(", ", "n_name", F.col("n_nationkey").cast("string"), (F.col("n_nationkey") + 100).cast("string"),
                    F.lower("r_name"), F.lit("")).alias("token_list"))
    tok = raw.select(F.explode(F.split("token_list", ",")).alias("__t")).select(F.trim("__t").alias("token")) \
        .where(F.col("token") != "").distinct()
    byname = t.nation.select(F.upper("n_name").alias("__u"), F.col("n_nationkey").alias("__kn"))
    bycode = t.nation.select(F.col("n_nationkey").alias("__code"), F.col("n_nationkey").alias("__kc"))
    j = dimension_join(tok.withColumn("__u", F.upper("token")), byname, "__u", "left")
    j = dimension_join(j.withColumn("__code", try_cast("token", "int")), bycode, "__code", "left")
    status = (F.when(F.col("__kn").isNotNull(), "name").when(F.col("__kc").isNotNull(), "code")
              .when(F.col("token").rlike("^[0-9]{3}$"), "code3").otherwise("invalid"))
    return j.select("token", F.coalesce("__kn", "__kc").alias("nation_key"), status.alias("status")).distinct()


@query("hash_sample_n", """
select l_orderkey, l_linenumber from lineitem
order by md5(cast(l_orderkey * 10 + l_linenumber as varchar) || '42'), l_orderkey * 10 + l_linenumber limit 100""")
def hash_sample_n(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber",
                                           (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("__k"))
    return clean.hash_sample_n(li, "__k", 100, seed=42).drop("__k")


@query("group_sample_n", """
select event_id, event_type, sample_rank from (
  select event_id, event_type, row_number() over (partition by event_type
         order by md5(cast(event_id as varchar) || '42'), event_id) as sample_rank from events) where sample_rank <= 50""")
def group_sample_n(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "event_type")
    return clean.group_sample_n(e, "event_type", "event_id", 50, seed=42).select("event_id", "event_type", F.col("sample_rank").cast("bigint"))


@query("split_parts", """
with t as (select p_partkey, trim(case when p_size < 10 then p_name || ' ' || p_type when p_size > 40 then p_type
                                  else p_name end) as line from part),
s as (select p_partkey, string_split(line, ' ') as parts from t)
select p_partkey, trim(parts[1]) as author, case when len(parts) >= 2 then trim(parts[2]) end as publisher,
       case when len(parts) >= 3 then trim(parts[3]) end as pub_date from s""")
def split_parts(spark, sf):
    p = Tables(spark, sf).part
    line = F.when(F.col("p_size") < 10, F.concat_ws(" ", "p_name", "p_type")).when(
        F.col("p_size") > 40, F.col("p_type")).otherwise(F.col("p_name"))
    a, b, c = clean.split_author_line(line, " ")
    return p.select("p_partkey", a.alias("author"), b.alias("publisher"), c.alias("pub_date"))


@query("fallback_rank", """
select conv_id, turn, coalesce(case when role <> 'user' then conv_id * 1000 + turn end, (conv_id - 1) * 20 + turn + 1) as rank
from conversations""")
def fallback_rank(spark, sf):
    """Derived rank (page-1)*size + position when the listed rank is missing."""
    c = Tables(spark, sf).conversations
    listed = F.when(F.col("role") != "user", F.col("conv_id") * 1000 + F.col("turn"))
    return c.select("conv_id", "turn", F.coalesce(listed, (F.col("conv_id") - 1) * 20 + F.col("turn") + 1).alias("rank"))


@query("url_parts", """
with p as (select page_id, url, regexp_extract(url, '^(https?://[^/?#]+)', 1) as host,
                  coalesce(regexp_replace(regexp_extract(regexp_extract(html, '(?is)<a\\s[^>]*?\\bhref\\s*=[^>]*>'),
                                                         '(?is)\\shref\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1), '^["'']|["'']$', '', 'g'), '') as link from pages)
select page_id, string_split(url, '/')[-1] as tail, host,
       case when starts_with(link, 'http://') or starts_with(link, 'https://') then link
            when starts_with(link, '/') then host || link else host || '/' || link end as first_link
from p""")
def url_parts(spark, sf):
    p = Tables(spark, sf).pages
    host = clean.url_host(F.col("url"))
    link = F.coalesce(F.get(documents.anchors(F.col("html")), F.lit(0))["href"], F.lit(""))
    return p.select("page_id", clean.url_tail(F.col("url")).alias("tail"), host.alias("host"),
                    clean.absolute_url(link, host).alias("first_link"))


# ------------------------------------------------------------------ scalar functions (2.8)

@query("text_normalize", """
select doc_id, lower(trim(regexp_replace(regexp_replace(text, '<[^>]+>', '', 'g'), '[^\\p{L}\\p{N}\\s]', '', 'g'))) as clean_text,
       case when length(text) > 100 then left(text, 100) || '...' else text end as preview
from documents""")
def text_normalize(spark, sf):
    """Strip tags, keep letters/digits/blanks, lower/trim; 100-char preview."""
    d = Tables(spark, sf).documents
    return d.select("doc_id", F.lower(F.trim(C.keep_word_chars(C.strip_tags(F.col("text"))))).alias("clean_text"),
                    C.truncate_text(F.col("text"), 100).alias("preview"))


@query("date_parts", """
select o_orderkey, cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m,
       cast(dayofyear(o_orderdate) as int) as doy, cast(isodow(o_orderdate) - 1 as int) as weekday,
       strftime(o_orderdate, '%Y-%m-%d') as ymd, strftime(o_orderdate, '%m/%d') as md from orders""")
def date_parts(spark, sf):
    """D3f/D4f: calendar parts; weekday 0 = Monday (the pandas convention)."""
    o = Tables(spark, sf).orders
    d = F.col("o_orderdate")
    return o.select("o_orderkey", F.year(d).alias("y"), F.month(d).alias("m"), F.dayofyear(d).alias("doy"),
                    F.weekday(d).alias("weekday"), F.date_format(d, "yyyy-MM-dd").alias("ymd"),
                    F.date_format(d, "MM/dd").alias("md"))


@query("cycle_encoding", f"""
select o_orderkey, round(sin(2 * pi() * dayofyear(o_orderdate) / 365.25), {R}) as doy_sin,
       round(cos(2 * pi() * dayofyear(o_orderdate) / 365.25), {R}) as doy_cos from orders""")
def cycle_encoding(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", C.round_half_away(C.cycle_sin("o_orderdate"), R).alias("doy_sin"),
                    C.round_half_away(C.cycle_cos("o_orderdate"), R).alias("doy_cos"))


@query("flag_threshold", """
select event_id, coalesce(cast(value >= 33 as int), 0) as hot_flag from events""")
def flag_threshold(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id", C.flag_at_least("value", 33).alias("hot_flag"))


@query("degree_to_point", """
select l_orderkey, l_linenumber,
  (['N','NNE','NE','ENE','E','ESE','SE','SSE','S','SSW','SW','WSW','W','WNW','NW','NNW'])
    [cast(floor((((l_extendedprice % 360 + 11.25) % 360) + 360) % 360 / 22.5) as int) + 1] as direction
from lineitem""")
def degree_to_point(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     C.degree_to_point(F.col("l_extendedprice") % 360).alias("direction"))


@query("parse_compact_date", """
select o_orderkey, txt, case when regexp_matches(txt, '^[0-9]{8}$') then try_strptime(txt, '%Y%m%d')::date end as parsed
from (select o_orderkey, case when o_orderpriority = '5-LOW' then strftime(o_orderdate, '%Y%m%-d')
                              else strftime(o_orderdate, '%Y%m%d') end as txt from orders)""")
def parse_compact_date(spark, sf):
    """D1f: yyyyMMdd text -> date; malformed text (7 digits here) -> NULL."""
    o = Tables(spark, sf).orders
    txt = F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyyMMd")) \
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    t = o.select("o_orderkey", txt.alias("txt"))
    return t.withColumn("parsed", C.parse_compact_date("txt"))


@query("parse_rfc_date", """
with t as (select event_id, strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' +0900' as txt from events)
select event_id, txt, (strptime(regexp_replace(txt, '^[A-Za-z]{3},\\s*', ''), '%d %b %Y %H:%M:%S %z') at time zone 'UTC')::timestamp as parsed
from t""")
def parse_rfc_date(spark, sf):
    """D2f: RFC-1123 text (built from event times, +0900) -> UTC timestamp."""
    e = Tables(spark, sf).events
    t = e.select("event_id", F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0900")).alias("txt"))
    return t.withColumn("parsed", C.parse_rfc1123("txt"))
