"""Text queries over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.operators import text as X
from sparkpanel.functions import columns as C
from sparkpanel.plans.registry import query
from sparkpanel.sources.tables import Tables

R = 4

_STOP_SQL = ", ".join(f"'{w}'" for w in X.STOP_WORDS)


def _tokens_sql(src: str, keep: str = "") -> str:
    sel = f"{keep}, " if keep else ""
    return f"""(select {sel}token from (
  select {sel}unnest(regexp_split_to_array(regexp_replace(regexp_replace(coalesce(text, ''), '<[^>]+>', '', 'g'),
                                                           '[^가-힣a-zA-Z0-9{X.BLANKS}]', '', 'g'), '[{X.BLANKS}]+')) as token from {src})
  where length(token) >= 2 and token not in ({_STOP_SQL}))"""


@query("word_frequency", f"""
select token, count(*) as n from {_tokens_sql('documents')} group by token order by n desc, token limit 15""", headline=True)
def word_frequency(spark, sf):
    return X.word_frequency(Tables(spark, sf).documents, "text", 15)


@query("word_frequency_by_group", f"""
select lang, token, n, rank from (
  select lang, token, n, row_number() over (partition by lang order by n desc, token) as rank
  from (select lang, token, count(*) as n from {_tokens_sql('documents', 'lang')} group by 1, 2)) where rank <= 15""")
def word_frequency_by_group(spark, sf):
    w = X.word_frequency_by_group(Tables(spark, sf).documents, "text", "lang", 15)
    return w.select("lang", "token", "n", F.col("rank").cast("bigint"))


@query("combined_word_frequency", f"""
select token, count(*) as n from {_tokens_sql('(select text from documents union all select text from conversations)')}
group by token order by n desc, token limit 15""")
def combined_word_frequency(spark, sf):
    """H3: the texts of several sources combined, then H1."""
    t = Tables(spark, sf)
    u = t.documents.select("text").unionByName(t.conversations.select("text"))
    return X.word_frequency(u, "text", 15)


def _tfidf_sql(vocab: int, min_len: int) -> str:
    return f"""
with d as (select doc_id, lower(text) as t from documents where text is not null),
n as (select count(*)::double as n from d),
tok as (select doc_id, unnest(regexp_extract_all(t, '[\\p{{L}}\\p{{N}}_]+')) as term from d),
dt as (select doc_id, term, count(*) as tf from tok where length(term) >= {min_len} group by 1, 2),
st as (select term, sum(tf) as cf, count(*) as df from dt group by 1),
v as (select term, ln((1 + (select n from n)) / (1 + df)) + 1 as idf from st order by cf desc, term limit {vocab}),
w as (select doc_id, term, tf * idf as w from dt join v using (term)),
x as (select term, w / sqrt(sum(w * w) over (partition by doc_id)) as x from w)
select term, round(sum(x), {R}) as score from x group by term order by sum(x) desc, term limit 30"""


@query("tfidf_top30", _tfidf_sql(30, 2))
def tfidf_top30(spark, sf):
    """H4: vocabulary 30, tokens of >= 2 word characters, L2 norm, summed per term."""
    t = X.tfidf_top(Tables(spark, sf).documents, "doc_id", "text", vocab_size=30, top=30, min_token_len=2)
    return t.select("term", C.round_half_away("score", R).alias("score"))


@query("tfidf_v1000", _tfidf_sql(1000, 1))
def tfidf_v1000(spark, sf):
    """H5: one-character tokens kept, vocabulary 1000, top 30 by summed score."""
    t = X.tfidf_top(Tables(spark, sf).documents, "doc_id", "text", vocab_size=1000, top=30, min_token_len=1)
    return t.select("term", C.round_half_away("score", R).alias("score"))
