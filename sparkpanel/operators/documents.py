"""Page and JSON record extraction (H6-H9, J1f-J6f, S10, S15, S19).

Pages are rows of a table; extraction is native regex (``regexp_extract`` /
``regexp_extract_all``) per row, so it scales with the page table.  JSON uses
``from_json`` / ``get_json_object`` with explicit schemas, or VARIANT for open
schemas.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkpanel.session import scratch_path

#: the inside of a tag: quoted parts may hold anything (possessive, so long or broken tags are read once)
INSIDE = r"""[^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+"""
#: one attribute: name, then an optional value (double-quoted, single-quoted or bare)
ATTRIBUTE = r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute ``name`` in the inside of a tag; null when absent."""
    found = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 0)
    mine = F.filter(found, lambda a: F.lower(F.substring_index(a, "=", 1)).rlike(rf"^{name}\s*$"))
    value = F.regexp_extract(F.try_element_at(mine, F.lit(1)), ATTRIBUTE, 2)
    return decode_entities(F.regexp_replace(value, "^[\"']|[\"']$", ""))


def meta_content(html: Column, *names: str) -> Column:
    """Content of the page's meta tags by name: every ``<meta ...>`` is parsed into its
    attributes, whatever their order and quotes.  For each of ``names`` in turn a tag whose
    ``property`` is the name counts before one whose ``name`` is; empty contents are skipped."""
    tags = F.regexp_extract_all(html, F.lit(rf"(?is)<meta\b({INSIDE})>"), 1)
    parsed = F.transform(tags, lambda t: F.struct(F.lower(attribute(t, "property")).alias("property"), F.lower(attribute(t, "name")).alias("name"),
                                                  F.nullif(attribute(t, "content"), F.lit("")).alias("content")))

    def first(metas: Column, name: str, key: str) -> Column:
        named = F.filter(metas, lambda m: m[key].eqNullSafe(F.lit(name.lower())) & m["content"].isNotNull())
        return F.try_element_at(named, F.lit(1))["content"]

    def pick(metas: Column) -> Column:
        return F.coalesce(*[first(metas, n, key) for n in names for key in ("property", "name")])

    return F.transform(F.array(parsed), pick)[0]


def page_title(html: Column) -> Column:
    """Inside of the first ``<title>``, whatever attributes it has."""
    return F.trim(F.regexp_extract(html, rf"(?is)<title(?:\s{INSIDE})?>(.*?)</title>", 1))


def first_heading(html: Column) -> Column:
    """Inside of the first ``<h1>``, whatever attributes it has."""
    return F.trim(F.regexp_extract(html, rf"(?is)<h1(?:\s{INSIDE})?>(.*?)</h1>", 1))


def page_language(html: Column) -> Column:
    """The ``lang`` of the ``<html>`` tag in any attribute order and quotes; null when absent."""
    return attribute(F.regexp_extract(html, rf"(?is)<html\b({INSIDE})>", 1), "lang")


def decode_entities(x: Column) -> Column:
    """The common named entities and their numeric forms (``&amp;`` last, so nothing is decoded twice)."""
    for ent, ch in [("&lt;", "<"), ("&#60;", "<"), ("&gt;", ">"), ("&#62;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"),
                    ("&apos;", "'"), ("&#x27;", "'"), ("&nbsp;", "\u00a0"), ("&#160;", "\u00a0"), ("&#38;", "&"), ("&amp;", "&")]:
        x = F.replace(x, F.lit(ent), F.lit(ch))
    return x


def strip_scripts(html: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>", ""),
                            r"(?is)<style[^>]*>.*?</style>", "")


#: an anchor's attributes and its inside; a paragraph's inside (attributes of the tag are skipped)
ANCHOR = rf"(?is)<a\s({INSIDE})>(.*?)</a>"
PARAGRAPH = rf"(?is)<p(?:\s{INSIDE})?>(.*?)</p>"


def anchors(html: Column) -> Column:
    """Array of (href, inside) of the anchors that have an href, in any attribute order and quotes."""
    found = F.regexp_extract_all(html, F.lit(ANCHOR), 0)  # one pass over the page; the parts are cut from the short pieces
    return F.filter(F.transform(found, lambda a: F.struct(attribute(F.regexp_extract(a, ANCHOR, 1), "href").alias("href"),
                                                          F.regexp_extract(a, ANCHOR, 2).alias("text"))), lambda a: a["href"].isNotNull())


def links(df: DataFrame, id_col: str, html: str) -> DataFrame:
    """H7: one page -> one row per anchor (position, href, text)."""
    return df.select(id_col, F.posexplode(anchors(F.col(html))).alias("pos", "a")).select(
        id_col, (F.col("pos") + 1).alias("link_no"), F.col("a.href").alias("href"),
        F.trim(decode_entities(F.regexp_replace("a.text", "<[^>]+>", ""))).alias("link_text"))


def paragraphs(html: Column) -> Column:
    """Text of every <p ...>...</p> span (tags stripped, entities decoded, trimmed)."""
    ps = F.regexp_extract_all(strip_scripts(html), F.lit(PARAGRAPH), 1)
    return F.transform(ps, lambda p: F.trim(decode_entities(F.regexp_replace(p, "<[^>]+>", ""))))


def page_summary(html: Column, min_len: int = 10, n_details: int = 3, preview: int = 100):
    """H9: paragraphs longer than min_len; first as summary (100 chars + '...'), next 3 as details."""
    ps = F.filter(paragraphs(html), lambda p: F.length(p) > min_len)
    first = F.element_at(ps, 1)
    summary = F.when(F.size(ps) == 0, F.lit(None)).when(F.length(first) > preview,
                                                         F.concat(F.left(first, F.lit(preview)), F.lit("..."))).otherwise(first)
    details = F.slice(ps, 2, n_details)
    return summary, details


# ---------------------------------------------------------------- JSON

def flatten_struct(df: DataFrame, col: str, sep: str = "_", prefix: str | None = None) -> DataFrame:
    """J1f: recursively select struct leaves as ``parent_child`` columns (schema-driven)."""
    prefix = col if prefix is None else prefix
    schema = df.schema[col].dataType
    out = []

    def walk(path: list[str], dt):
        if isinstance(dt, StructType):
            for f in dt.fields:
                walk(path + [f.name], f.dataType)
        else:
            out.append(F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(([prefix] if prefix else []) + path[1:])))

    walk([col], schema)
    return df.select(*[c for c in df.columns if c != col], *out)


def open_leaves(df: DataFrame, key: str, raw: str) -> DataFrame:
    """J1f / J3f for JSON of any shape: (key, path, type, value), one row per leaf of every document.

    ``variant_explode`` opens one level of all documents at a time; levels are written, so each
    is parsed once, and the loop ends with the deepest document.  Paths read ``$.a.b[0]`` or
    ``$['odd name']``; types are the variant's (``BIGINT``, ``STRING``, ``VOID`` for null, ...),
    empty objects and lists are leaves of type ``OBJECT<>`` and ``ARRAY<>``.  Null and malformed
    documents have no rows; repeated rows are opened each; a repeated key inside one object makes the document malformed.
    """
    spark = df.sparkSession
    level = df.select(F.col(key).alias("__key"), F.lit("$").alias("path"), F.try_parse_json(raw).alias("v")).where(F.col("v").isNotNull())
    text, opens = F.col("v").cast("string"), F.col("type").rlike("^(OBJECT|ARRAY)<") & ~F.col("type").isin("OBJECT<>", "ARRAY<>")
    shape = F.schema_of_variant("v")
    kind = F.when(shape.startswith("ARRAY<") & (text == "[]"), F.lit("ARRAY<>")).otherwise(shape)
    found = None
    while True:
        path = scratch_path(spark, "json-level")
        level.withColumn("type", kind).write.parquet(path)
        level = spark.read.parquet(path)
        leaves = level.where(~opens).select("__key", "path", "type", F.when(F.col("type") != "VOID", text).alias("value"))
        found = leaves if found is None else found.unionByName(leaves)
        inner = level.where(opens)
        if inner.isEmpty():
            return found.withColumnRenamed("__key", key)
        step = F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos"), F.lit("]"))) \
            .when(F.col("key").rlike("^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(F.lit("."), "key")).otherwise(F.concat(F.lit("['"), "key", F.lit("']")))
        level = inner.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())) \
            .select("__key", F.concat("path", step).alias("path"), F.col("value").alias("v"))


def open_columns(df: DataFrame, raw: str, prefix: str = "", sep: str = "_") -> DataFrame:
    """J1f / U4: JSON objects of any shape as columns, ``a_b`` for the value at ``a.b``; ``raw`` is replaced.

    One aggregation (``schema_of_variant_agg``) finds the union of all shapes; documents without a
    field have null there, a field that is an object here and a scalar there stays a variant.
    Documents that are no objects are rejected.
    """
    parsed = df.withColumn("__v", F.try_parse_json(raw))
    found = parsed.agg(F.schema_of_variant_agg("__v").alias("s")).first()["s"]
    if found == "VOID":
        return df.drop(raw)
    if not found.startswith("OBJECT<"):
        raise ValueError(f"documents are not all objects: {found}")
    ddl = re.sub(r"\bVOID\b", "STRING", found.replace("OBJECT<>", "STRING").replace("OBJECT<", "STRUCT<"))
    # the alias of the column is the first step of every path, so it is dropped by flatten_struct's prefix
    wide = parsed.drop(raw).withColumn("__v", F.try_variant_get("__v", "$", ddl))
    return flatten_struct(wide, "__v", sep, prefix)


def amount_fields(raw: Column, keys: list[str]) -> list[Column]:
    """J2f: ``{"price": {"amount": x, "display_amount": "..."}}`` -> price_amount, price_display.

    A key holding a scalar keeps its value; malformed JSON yields NULLs.
    """
    v = F.try_parse_json(raw)
    cols = []
    for k in keys:
        cols.append(F.coalesce(F.try_variant_get(v, f"$.{k}.amount", "double"),
                               F.try_variant_get(v, f"$.{k}", "double")).alias(f"{k}_amount"))
        cols.append(F.try_variant_get(v, f"$.{k}.display_amount", "string").alias(f"{k}_display"))
    return cols


def first_value_type(df: DataFrame, raw: str, keys: list[str], order: str) -> DataFrame:
    """J3f: SQL type of each key, from its first valid value in ``order``.

    int / bool -> INTEGER, float -> REAL, else TEXT.  ``min_by`` is a partial
    aggregate, so the per-key reduction is skew-safe.
    """
    v = F.try_parse_json(F.col(raw))
    rows = []
    for k in keys:
        t = F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant"))
        typ = (F.when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "BOOLEAN"), "INTEGER")
               .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "REAL").otherwise("TEXT"))
        rows.append(F.struct(F.lit(k).alias("key"), F.when(F.try_variant_get(v, f"$.{k}", "variant").isNotNull(), typ).alias("t")))
    long = df.select(order, F.explode(F.array(*rows)).alias("s")).select(order, "s.*").where(F.col("t").isNotNull())
    return long.groupBy("key").agg(F.min_by("t", order).alias("sql_type"))


#: keys under which a reviews page may hold its list of records
REVIEW_LISTS = ("commentList", "comments", "reviews", "commentTagList")


def review_records(raw: Column, list_keys=REVIEW_LISTS) -> Column:
    """Array of record JSON texts: the first of ``list_keys`` that holds a list, else the value itself."""
    lists = [F.from_json(F.get_json_object(raw, f"$.{k}"), "array<string>") for k in list_keys]
    return F.coalesce(*lists, F.array(raw))


def tolerant_reviews(raw: Column):
    """Title / content / rating under alternative field names, stripped; empty texts count as absent."""
    def first(*names):
        return F.coalesce(*[F.nullif(F.trim(F.get_json_object(raw, f"$.{n}")), F.lit("")) for n in names])

    return first("title", "subject"), first("content", "body", "text"), first("rating", "score")
