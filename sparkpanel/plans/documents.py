"""Page and JSON extraction queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from sparkpanel.functions.columns import safe_double
from sparkpanel.operators import cards
from sparkpanel.operators import documents as D
from sparkpanel.functions import columns as C
from sparkpanel.plans.registry import query
from sparkpanel.session import scratch_path
from sparkpanel.sources import files
from sparkpanel.sources.tables import Tables

R = 4


_DECODE_SQL = "replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"
# DuckDB: the inside of a tag, and one attribute's value in it (single quotes doubled for SQL)
_INSIDE = """(?:[^>"'']|"[^"]*"|''[^'']*'')*"""
_ATTR = """(?is)(?:^|[\\s"''/]){name}\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)"""
_ANCHOR = f"(?is)<a\\s({_INSIDE})>(.*?)</a>"


def _attr_sql(tag: str, name: str) -> str:
    value = f"nullif(regexp_extract({tag}, '{_ATTR.format(name=name)}', 1), '')"
    return _DECODE_SQL.format(x=f"regexp_replace({value}, '^[\"'']|[\"'']$', '', 'g')")


def _meta_sql(name: str) -> str:
    """First non-empty content of a tag with this property, else with this name."""
    pick = ("list_filter(list_transform(list_filter(metas, lambda m: lower({key}) = '{name}'), "
            "lambda m: nullif({content}, '')), lambda c: c is not null)[1]")
    return ", ".join(pick.format(key=_attr_sql("m", k), name=name, content=_attr_sql("m", "content")) for k in ("property", "name"))


@query("html_meta", f"""
select page_id, coalesce(nullif(trim(regexp_extract(html, '(?is)<title(?:\\s{_INSIDE})?>(.*?)</title>', 1)), ''),
                         nullif(trim(regexp_extract(html, '(?is)<h1(?:\\s{_INSIDE})?>(.*?)</h1>', 1)), '')) as page_title,
       coalesce({_meta_sql('description')}, {_meta_sql('og:description')}) as meta_description,
       coalesce({_meta_sql('og:image')}) as meta_image,
       lang
from (select page_id, html, {_attr_sql(f"regexp_extract(html, '(?is)<html\\b({_INSIDE})>', 1)", 'lang')} as lang,
             regexp_extract_all(html, '(?is)<meta\\b({_INSIDE})>', 1) as metas from pages)""")
def html_meta(spark, sf):
    """H6: title (fallback h1), meta description and image from parsed meta tags."""
    p = Tables(spark, sf).pages
    h = F.col("html")
    title = F.coalesce(F.nullif(D.page_title(h), F.lit("")), F.nullif(D.first_heading(h), F.lit("")))
    return p.select("page_id", title.alias("page_title"),
                    D.meta_content(h, "description", "og:description").alias("meta_description"),
                    D.meta_content(h, "og:image").alias("meta_image"),
                    D.page_language(h).alias("lang"))


@query("html_cards", f"""
with a as (select page_id, list_transform(regexp_extract_all(html, '{_ANCHOR}', 1), lambda t: {_attr_sql('t', 'href')}) as hrefs,
                  regexp_extract_all(html, '{_ANCHOR}', 2) as texts from pages),
u as (select page_id, unnest(generate_series(1, len(hrefs))) as link_no, hrefs, texts from a)
select page_id, link_no, hrefs[link_no] as href,
       trim({_DECODE_SQL.format(x="regexp_replace(texts[link_no], '<[^>]+>', '', 'g')")}) as link_text from u""")
def html_cards(spark, sf):
    """H7: one page -> n records (anchors with position, target and text)."""
    return D.links(Tables(spark, sf).pages, "page_id", "html")


@query("page_records", f"""
with s as (select page_id, regexp_extract_all(html, '(?is)<li>(.*?)</li>', 1) as items from pages),
i as (select page_id, unnest(generate_series(1, len(items))) as record_no, items from s)
select page_id, record_no::int as record_no, {_attr_sql("regexp_extract(items[record_no], '(?is)<a\\s(" + _INSIDE + ")>', 1)", 'href')} as href,
       nullif(trim({_DECODE_SQL.format(x="regexp_replace(items[record_no], '<[^>]+>', '', 'g')")}), '') as label from i""")
def page_records(spark, sf):
    """H7: the entries of every page's navigation list, one record each."""
    return cards.page_records(Tables(spark, sf).pages, "page_id", "html", "nav li",
                              [cards.Field("href", ("a@href",)), cards.Field("label", ("a",))])


@query("page_articles", r"""
with a as (select page_id, regexp_extract(html, '(?s)<article>(.*)</article>', 1) as inside from pages)
select page_id, 1 as record_no,
       trim(regexp_replace(replace(regexp_extract(inside, '(?s)<h1>(.*?)</h1>', 1), '&amp;', '&'), '\s+', ' ', 'g')) as headline,
       trim(regexp_replace(replace(replace(regexp_extract(inside, '(?s)<b>(.*?)(?:<p>|</p>|$)', 1), '<br>', ''), '&amp;', '&'), '\s+', ' ', 'g')) as lead
from a""")
def page_articles(spark, sf):
    """H7: headline and lead of every article; the lead's ``<b>`` is never closed, the next paragraph ends it."""
    return cards.page_records(Tables(spark, sf).pages, "page_id", "html", "article",
                              [cards.Field("headline", ("h1",)), cards.Field("lead", ("p b",))])


def listing_pages(spark, sf):
    """Listing pages rendered from ``part``: 20 product blocks a page, with missing fields, three attribute
    forms, entities and unclosed list items."""
    p = Tables(spark, sf).part
    k = F.col("p_partkey")
    name = F.concat("p_name", F.lit(" &amp; "), "p_brand")
    ident = F.when(k % 5 == 0, F.format_string("id=pid_%d", k)).otherwise(F.format_string('data-product-id="%d"', k))
    price = F.format_string('<span class="price">$ <b>%s</b></span>', F.col("p_retailprice").cast("string"))
    stars = F.when(k % 3 == 0, F.format_string("<a class='stars' title='%d/50'>*</a>", "p_size")).otherwise("")
    block = F.format_string(
        "<div class='item product' %s><div itemprop=\"sku\" content='P-%d'></div><a href=\"/pr/%d\" title=\"%s\" class=product-link><img src=/i/%d.png></a>"
        '<ul><li class=brand>%s<li class="type">%s</ul><div class=buy>%s</div>%s</div>', ident, k, k, name, k, F.col("p_brand"), F.col("p_type"), price, stars)
    g = p.select(k, F.floor(k / 20).alias("page_no"), block.alias("block")).groupBy("page_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "block"))), lambda b: b["block"]), "\n").alias("blocks"))
    return g.select("page_no", F.concat(F.lit("<!doctype html><html><body><!-- <div class=product> --><span class=price>0</span>"), "blocks",
                                        F.lit("</body></html>")).alias("html"))


@query("product_cards", """
select p_partkey // 20 as page_no, row_number() over (partition by p_partkey // 20 order by p_partkey)::int as record_no,
       p_partkey as product_id, 'P-' || p_partkey as sku, p_name || ' & ' || p_brand as title, p_type as type, p_retailprice as price,
       case when p_partkey % 3 = 0 then p_size end as rating, '/pr/' || p_partkey as url, '/i/' || p_partkey || '.png' as image_url
from part""")
def product_cards(spark, sf):
    """H7: product records of listing pages: id with a fallback, sku, title, price, rating, link and image."""
    fields = [cards.Field("product_id", ("@data-product-id", "@id")), cards.Field("sku", ("div[itemprop=sku]@content",)),
              cards.Field("title", ("a.product-link@title",)), cards.Field("type", ("li.type",)), cards.Field("price", ("div.buy span.price b",)),
              cards.Field("rating", ("a.stars@title",)), cards.Field("url", ("a.product-link@href",)), cards.Field("image_url", ("img@src",))]
    d = cards.page_records(listing_pages(spark, sf), "page_no", "html", "div.product", fields)
    return d.select("page_no", "record_no", F.regexp_replace("product_id", "^pid_", "").cast("bigint").alias("product_id"), "sku", "title", "type",
                    safe_double(F.col("price")).alias("price"), F.substring_index("rating", "/", 1).cast("int").alias("rating"), "url", "image_url")


@query("page_summary", f"""
with s as (select page_id, regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'),
                                          '(?is)<style[^>]*>.*?</style>', '', 'g') as h from pages),
p as (select page_id, list_filter(list_transform(regexp_extract_all(h, '(?is)<p(?:\\s{_INSIDE})?>(.*?)</p>', 1),
        lambda x: trim({_DECODE_SQL.format(x="regexp_replace(x, '<[^>]+>', '', 'g')")})), lambda x: length(x) > 10) as ps from s)
select page_id, case when len(ps) = 0 then null when length(ps[1]) > 100 then left(ps[1], 100) || '...' else ps[1] end as summary,
       ps[2:4] as details from p""")
def page_summary(spark, sf):
    """H9: paragraphs > 10 chars: the first as summary, the next three as details."""
    p = Tables(spark, sf).pages
    summary, details = D.page_summary(F.col("html"))
    return p.select("page_id", summary.alias("summary"), details.alias("details"))


_NESTED = StructType([
    StructField("event_type", StringType()),
    StructField("metrics", StructType([StructField("value", DoubleType()), StructField("k", LongType()),
                                       StructField("who", StructType([StructField("user_id", LongType())]))])),
])


def _nested_json(e):
    return F.to_json(F.struct("event_type", F.struct(
        "value", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.struct("user_id").alias("who")).alias("metrics")))


def _open_json():
    """Documents of four shapes: nested objects, lists of objects, scalars and broken text, by event type."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    purchase = F.to_json(F.struct(F.struct("value", F.array(F.col("event_type"), F.lit("x")).alias("tags")).alias("sale"), F.struct("user_id").alias("who")))
    click = F.to_json(F.struct(F.array(F.struct(k.alias("at")), F.struct((k + 1).alias("at"))).alias("steps"), F.lit(True).alias("odd name")))
    return F.when(F.col("event_type") == "purchase", purchase).when(F.col("event_type") == "click", click) \
        .when(F.col("event_type") == "error", F.lit("{broken")).otherwise(F.col("props"))


@query("json_open_flatten", """
with e as (select event_id, event_type, user_id, value, cast(json_extract_string(props, '$.k') as bigint) as k from events)
select event_id, '$.sale.value' as path, 'DECIMAL' as type, printf('%.2f', value) as value from e where event_type = 'purchase' and value is not null
union all select event_id, '$.sale.tags[0]', 'STRING', event_type from e where event_type = 'purchase'
union all select event_id, '$.sale.tags[1]', 'STRING', 'x' from e where event_type = 'purchase'
union all select event_id, '$.who.user_id', 'BIGINT', user_id::varchar from e where event_type = 'purchase' and user_id is not null
union all select event_id, '$.steps[0].at', 'BIGINT', k::varchar from e where event_type = 'click'
union all select event_id, '$.steps[1].at', 'BIGINT', (k + 1)::varchar from e where event_type = 'click'
union all select event_id, '$[''odd name'']', 'BOOLEAN', 'true' from e where event_type = 'click'
union all select event_id, '$.k', 'BIGINT', k::varchar from e where event_type in ('view', 'signup')""")
def json_open_flatten(spark, sf):
    """J1f / J3f: every leaf of JSON documents of unknown shape: path, type and value."""
    d = D.open_leaves(Tables(spark, sf).events.withColumn("raw", _open_json()), "event_id", "raw")
    # a number's text and precision depend on its digits; the comparison takes the family and two digits
    dec = F.col("type").startswith("DECIMAL") | (F.col("type") == "DOUBLE") | (F.col("path") == "$.sale.value")
    return d.select("event_id", "path", F.when(dec, "DECIMAL").otherwise(F.col("type")).alias("type"),
                    F.when(dec, F.format_string("%.2f", F.col("value").cast("double"))).otherwise(F.col("value")).alias("value"))


@query("json_open_columns", """
select event_id, case when event_type in ('view', 'signup') then cast(json_extract_string(props, '$.k') as bigint) end as k,
       case when event_type = 'purchase' then value end as sale_value, case when event_type = 'purchase' then user_id end as who_user_id,
       case when event_type = 'click' then [cast(json_extract_string(props, '$.k') as bigint), cast(json_extract_string(props, '$.k') as bigint) + 1] end as steps
from events""")
def json_open_columns(spark, sf):
    """J1f / U4: the same documents as columns; fields that a document lacks are null."""
    d = D.open_columns(Tables(spark, sf).events.select("event_id", _open_json().alias("raw")), "raw")
    return d.select("event_id", "k", F.col("sale_value").cast("double").alias("sale_value"), "who_user_id",
                    F.transform("steps", lambda s: s["at"]).alias("steps"))


@query("json_flatten", """
select event_id, event_type as payload_event_type, value as payload_metrics_value,
       cast(json_extract_string(props, '$.k') as bigint) as payload_metrics_k, user_id as payload_metrics_who_user_id
from events""")
def json_flatten(spark, sf):
    """J1f: nested JSON record -> flat columns named parent_child (recursive, schema-driven)."""
    e = Tables(spark, sf).events
    j = e.select("event_id", F.from_json(_nested_json(e), _NESTED).alias("payload"))
    return D.flatten_struct(j, "payload")


@query("json_landing", """
select cast(day(ts) as int) as page, event_id as item_index,
       '{"event_type":"' || event_type || '","value":' || cast(value as varchar) || ',"props":' || cast(json(props) as varchar) || '}' as raw_data
from events""")
def json_landing(spark, sf):
    """Raw-JSON landing rows (page, item_index, raw_data) appended to the landing table, read back."""
    e = Tables(spark, sf).events
    raw = F.to_json(F.struct("event_type", "value", F.parse_json("props").alias("props")))
    out = scratch_path(spark, "landing")
    rows = e.select(F.dayofmonth("ts").alias("page"), F.col("event_id").alias("item_index"), raw.alias("raw_data"))
    for part in (F.col("page") <= 15, F.col("page") > 15):  # two scrape runs
        files.append_json_landing(rows.where(part), out)
    return spark.read.parquet(out).where(F.col("scraped_at").isNotNull()).drop("scraped_at")


_TREND_SCHEMA = "struct<results: array<struct<title: string, keywords: array<string>, data: array<struct<period: string, ratio: double>>>>>"


@query("json_results_explode", f"""
with d as (select event_type, strftime(cast(ts as date), '%Y-%m-%d') as period, count(*) as n from events group by 1, 2)
select event_type as title, period, round(n * 100.0 / max(n) over (partition by event_type), {R}) as ratio from d""")
def json_results_explode(spark, sf):
    """Trend JSON (results[].data[]) -> rows with the group title.

    The JSON is built from events (one document per keyword: its daily series),
    then parsed with an explicit schema and unfolded with two explodes.
    """
    e = Tables(spark, sf).events
    d = e.groupBy("event_type", F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("period")).agg(
        F.count(F.lit(1)).alias("n"))
    mx = d.groupBy("event_type").agg(F.max("n").alias("mx"))
    r = d.join(mx, "event_type").select("event_type", "period", (F.col("n") * 100.0 / F.col("mx")).alias("ratio"))
    # one JSON document per keyword; its data array is the keyword's daily series (bounded by the calendar)
    docs = r.groupBy("event_type").agg(F.to_json(F.struct(F.array(F.struct(
        F.col("event_type").alias("title"), F.array(F.col("event_type")).alias("keywords"),
        F.collect_list(F.struct("period", "ratio")).alias("data"))).alias("results"))).alias("raw"))
    parsed = docs.select(F.from_json("raw", _TREND_SCHEMA).alias("j"))
    res = parsed.select(F.explode("j.results").alias("r"))
    rows = res.select(F.col("r.title").alias("title"), F.explode("r.data").alias("d"))
    return rows.select("title", F.col("d.period").alias("period"), C.round_half_away("d.ratio", R).alias("ratio"))


def _review_json(c):
    return (F.when(F.col("role") == "user", F.to_json(F.struct(F.concat(F.lit("conv "), F.col("conv_id").cast("string")).alias("title"),
                                                               F.col("text").alias("content"), F.col("turn").alias("rating"))))
            .when(F.col("role") == "assistant", F.to_json(F.struct(F.col("text").alias("body"), F.col("turn").alias("score"))))
            .otherwise(F.to_json(F.struct(F.col("turn").alias("score")))))


@query("reviews_from_json", """
select conv_id, turn, coalesce(case when role = 'user' then 'conv ' || cast(conv_id as varchar) end) as title,
       text as content, cast(turn as varchar) as rating
from conversations where role in ('user', 'assistant')""")
def reviews_from_json(spark, sf):
    """Records under alternative field names; rows with no title and no content are skipped."""
    c = Tables(spark, sf).conversations
    j = c.select("conv_id", "turn", _review_json(c).alias("raw"))
    title, content, rating = D.tolerant_reviews(F.col("raw"))
    out = j.select("conv_id", "turn", title.alias("title"), content.alias("content"), rating.alias("rating"))
    return out.where(F.col("title").isNotNull() | F.col("content").isNotNull())


@query("reviews_from_pages", """
select conv_id, turn, case when role = 'user' then 'conv ' || cast(conv_id as varchar) end as title, text as content, cast(turn as varchar) as rating
from conversations where role in ('user', 'assistant') and trim(text) <> ''""")
def reviews_from_pages(spark, sf):
    """Review pages that hold their records under different list keys, each page with an empty record to skip."""
    c = Tables(spark, sf).conversations.where(F.col("role").isin("user", "assistant"))
    user = F.col("role") == "user"
    record = F.struct(F.when(user, F.concat(F.lit("conv "), F.col("conv_id").cast("string"))).alias("title"),
                      F.when(user, F.concat(F.lit(" "), F.col("text"))).alias("content"), F.when(~user, F.col("text")).alias("body"),
                      F.col("turn").alias("score"))
    empty = F.struct(F.lit("").alias("title"), F.lit("  ").alias("content"), F.lit(None).cast("string").alias("body"), F.lit(0).alias("score"))
    records = F.array(record, empty)
    page = F.when(F.col("conv_id") % 2 == 0, F.to_json(F.struct(records.alias("commentList")))).otherwise(F.to_json(F.struct(records.alias("comments"))))
    rows = c.select("conv_id", "turn", F.explode(D.review_records(page)).alias("raw"))
    title, content, rating = D.tolerant_reviews(F.col("raw"))
    out = rows.select("conv_id", "turn", title.alias("title"), content.alias("content"), rating.alias("rating"))
    return out.where(F.col("title").isNotNull() | F.col("content").isNotNull())


def _card_json():
    price = F.struct(F.col("p_retailprice").alias("amount"),
                     F.concat(F.lit("KRW "), F.col("p_retailprice").cast("string")).alias("display_amount"))
    good = F.to_json(F.struct("p_name", price.alias("price"), F.col("p_size").alias("size"),
                              (F.col("p_size") > 25).alias("big")))
    # cards of the largest parts arrive truncated (broken JSON)
    return F.when(F.col("p_size") >= 49, F.substring(good, 1, 20)).otherwise(good)


@query("json_card_fields", """
select p_partkey, case when p_size >= 49 then null else p_retailprice end as price_amount,
       case when p_size >= 49 then null else 'KRW ' || cast(p_retailprice as varchar) end as price_display,
       case when p_size >= 49 then null else cast(p_size as double) end as size_amount,
       cast(null as varchar) as size_display
from part""")
def json_card_fields(spark, sf):
    """J2f: {amount} -> _amount, {display_amount} -> _display; broken JSON -> NULL fields."""
    p = Tables(spark, sf).part
    return p.select("p_partkey", *D.amount_fields(_card_json(), ["price", "size"]))


@query("json_key_types", """
with c as (select p_partkey, case when p_size < 49 then json_object('p_name', p_name,
             'price', json_object('amount', p_retailprice, 'display_amount', 'KRW ' || cast(p_retailprice as varchar)),
             'size', p_size, 'big', p_size > 25) end as raw from part),
k as (select p_partkey, key, json_type(raw, '$.' || key) as jt
      from c, (values ('p_name'), ('price'), ('size'), ('big')) v(key) where raw is not null)
select key, arg_min(case when jt in ('BIGINT', 'UBIGINT', 'BOOLEAN') then 'INTEGER' when jt = 'DOUBLE' then 'REAL'
                         else 'TEXT' end, p_partkey) as sql_type
from k where jt is not null and jt <> 'NULL' group by key""")
def json_key_types(spark, sf):
    """J3f: column type of each card key from its first valid value (bool counts as int)."""
    p = Tables(spark, sf).part
    c = p.select("p_partkey", _card_json().alias("raw"))
    return D.first_value_type(c, "raw", ["p_name", "price", "size", "big"], "p_partkey")


@query("json_path_defaults", """
select event_id, coalesce(try_cast(json_extract_string(props, '$.k') as bigint), -1) as k,
       coalesce(json_extract_string(props, '$.missing'), 'n/a') as missing,
       try_cast(nullif(trim(case when event_type = 'error' then ' ' else json_extract_string(props, '$.k') end), '') as double) as k_safe
from events""")
def json_path_defaults(spark, sf):
    """J5f/J6f: JSON path with defaults; blank / text -> NULL double."""
    e = Tables(spark, sf).events
    raw_k = F.get_json_object("props", "$.k")
    return e.select("event_id", F.coalesce(raw_k.try_cast("bigint"), F.lit(-1).cast("bigint")).alias("k"),
                    F.coalesce(F.get_json_object("props", "$.missing"), F.lit("n/a")).alias("missing"),
                    safe_double(F.when(F.col("event_type") == "error", F.lit(" ")).otherwise(raw_k)).alias("k_safe"))


@query("link_list_text", f"""
with a as (select page_id, list_filter(list_transform(regexp_extract_all(html, '{_ANCHOR}', 1), lambda t: {_attr_sql('t', 'href')}),
                                       lambda x: x is not null) as hrefs from pages)
select page_id, array_to_string(hrefs, ', ') as links_text, list_sort(list_distinct(hrefs)) as distinct_links from a""")
def link_list_text(spark, sf):
    """F9 / A2f: a page's link list as comma text, and as a sorted distinct array."""
    p = Tables(spark, sf).pages
    hrefs = F.transform(D.anchors(F.col("html")), lambda a: a["href"])
    return p.select("page_id", F.array_join(hrefs, ", ").alias("links_text"),
                    F.array_sort(F.array_distinct(hrefs)).alias("distinct_links"))
