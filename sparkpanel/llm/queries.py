"""Registered queries of this subpackage and their DuckDB SQL (where SQL can express them)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkpanel.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn

    return deco


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in sequences of at most 1024 tokens."""
    from sparkpanel.llm.packing import pack_documents

    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op2_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    from sparkpanel.llm.quality_lines import judge

    return judge(table(spark, sf_dir, "documents"))


@query("op4_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without later copies of line runs of 50 words or more."""
    from sparkpanel.llm.line_dedup import dedup_lines

    d = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "text", "n_removed_lines", "n_removed_words")


@query("op5_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    from sparkpanel.llm.simhash import near_duplicates

    d = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return d.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; one crc32 class in four of the ids is never trained on."""
    from sparkpanel.llm.language_id import held_out, identify

    d = identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return d.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op3_warc")
def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archives."""
    from sparkpanel.llm.warc import round_trip

    d = round_trip(spark, table(spark, sf_dir, "pages"), min_bytes=0)
    return d.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: the rules of the URL filter query: host, path, verdict
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query("op6_url_filters", """
with u as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
r(h, q, rule, v) as (values ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
                            ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')),
m as (
  select p.*, (select max_by(struct_pack(rule := rule, v := v), length(rule)) from r
               where (p.host = r.h or ends_with(p.host, '.' || r.h)) and starts_with(p.path, r.q)) as b from p)
select page_id, host, path, b.rule as rule, coalesce(b.v, 'allow') as verdict from m
""")
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL under four rules."""
    from sparkpanel.llm.url_filter import judge_urls

    literal = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    rules = spark.sql(f"select * from values {literal} as t(host, path, verdict)")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


@query("op7_kd_sharding")
def kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight shards of nearly equal bytes."""
    from sparkpanel.llm.kd_shard import kd_shards

    d = kd_shards(table(spark, sf_dir, "documents"), n_shards=8)
    return d.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


@query("op8_sentencepiece")
def sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to piece ids and decoded again: digests of both sides."""
    from sparkpanel.llm.sentencepiece_viterbi import round_trip

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op9_nearest_neighbours")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    from sparkpanel.llm.ann import search

    d = search(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, k=10)
    return d.select("query_id", "rank", "vec_id", "score")


@query("op11_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it has more than 2048 tokens."""
    from sparkpanel.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@query("op12_lexical_search", r"""
with d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
q as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
total as (select count(*) filter (where len(w) > 0) as n_docs, sum(len(w))::bigint as n_terms from d),
size as (select r, doc_id, len(w) as n from d),
found as (select r, unnest(w) as term from d),
tf as (select r, term, count(*) as tf from found where term in (select term from q) group by r, term),
df as (select term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::bigint as w from tf, total group by term),
scored as (
  select q.item_id, tf.r, sum(df.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * size.n * n_docs) // n_terms))))::bigint as score
  from q join tf using (term) join df using (term) join size on size.r = tf.r, total group by q.item_id, tf.r),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank, doc_id, score
  from scored join size using (r) where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 50
""")
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    from sparkpanel.llm.lexical_search import rank

    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query("op13_prefix_trie", """
with recursive t as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p,
         coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
own as (
  select c, count(*) as n, list_reduce(list_transform(range(1, length(c::varchar) + 1), lambda i: ascii(substr(c::varchar, i, 1))::bigint),
           lambda crc, x: list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1))), 4294967295) as crc
  from t group by c),
head as (select c, n, xor(crc, 4294967295) % 6 as h from own),
lent as (select a.c, a.n, a.h, least(a.h, coalesce(b.n, 0)) as k from head a left join own b on b.c = a.c - a.c % 100),
built as (
  select l.c, t.p as d, t.role, t.text from lent l join t on t.c = l.c - l.c % 100 and t.p <= l.k
  union all select l.c, t.p - l.h + l.k, t.role, t.text from lent l join t on t.c = l.c and t.p > l.h),
path as (
  select c, 0::bigint as d, 0::bigint as node, null::bigint as up, 0 as chars from own
  union all
  select b.c, b.d, min(b.c) over (partition by b.d, path.node, b.role, b.text) * 100000 + b.d, path.node, length(b.text)
  from path join built b on b.c = path.c and b.d = path.d + 1),
node as (select node, any_value(d) as d, any_value(up) as up, min(c) as first, count(*) as n, any_value(chars) as chars from path group by node),
child as (select up as node, count(*) as n_children from node where up is not null group by up),
full_node as (select node.*, coalesce(n_children, 0) as n_children from node left join child using (node)),
below as (
  select a.node, sum(case when f.n_children = 0 then 1 else 0 end) as n_leaves, sum((f.n - 1) * f.chars) as saved
  from full_node f join path a on a.c = f.first and a.d <= f.d group by a.node),
last as (select c, max(d) as d from path group by c),
ends as (select node, sha256(string_agg(c::varchar, ',' order by c)) as ends from last join path using (c, d) group by node)
select f.first as conv_id, f.d as depth, u.first as parent_conv_id, f.n as n_convs, f.n_children, b.n_leaves::bigint as n_leaves,
       b.saved::bigint as saved_tokens, coalesce(e.ends, sha256('')) as ends_sha256
from full_node f join below b using (node) left join ends e using (node) left join node u on u.node = f.up
""")
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    from sparkpanel.llm.prefix_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))
