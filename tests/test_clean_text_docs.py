"""Cleaning, tagging, text and document operators on hand-made fixtures."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkpanel.functions import columns as C
from sparkpanel.operators import clean, documents, tag, text

BRAND_NAMES = ["버거킹 강남점", "Burger King Gangnam", "burger_king 2", "맥도날드", "McDonald's", "KFC 역삼",
               "케이에프씨 종로", "롯데리아", "lotteria x", "맘스터치", "mom's touch", None, "김밥천국"]


def test_brand_rules_disagree_on_korean_kfc(spark):
    df = spark.createDataFrame([(n,) for n in BRAND_NAMES], "name string")
    a = [r.t for r in df.select(tag.tag_by_rules(F.col("name"), tag.BRAND_RULES_A).alias("t")).collect()]
    b = [r.t for r in df.select(tag.tag_by_regex_alias(F.col("name"), tag.BRAND_PATTERN_B, tag.BRAND_ALIASES_B).alias("t")).collect()]
    assert a == ["버거킹", "버거킹", "기타", "맥도날드", "맥도날드", "KFC", "KFC", "롯데리아", "롯데리아", "기타", "기타", "기타", "기타"]
    assert b == ["버거킹", "버거킹", "버거킹", "맥도날드", "맥도날드", "KFC", "기타", "롯데리아", "롯데리아", "맘스터치", "맘스터치",
                 "기타", "기타"]


def test_money_and_safe_double(spark):
    df = spark.createDataFrame([("12,300",), ("",), ("n/a",), (" 7 ",), (None,)], "t string")
    r = df.select(C.money_text_to_long("t").alias("m"), C.safe_double("t").alias("d")).collect()
    assert [x.m for x in r] == [12300, 0, 0, 7, 0]
    assert [x.d for x in r] == [None, None, None, 7.0, None]


def test_dates(spark):
    df = spark.createDataFrame([("20260608",), ("2026068",), ("",), ("Mon, 08 Jun 2026 10:00:00 +0900",)], "t string")
    r = df.select(C.parse_compact_date("t").alias("d"), C.parse_rfc1123("t").cast("timestamp_ntz").alias("ts")).collect()
    assert str(r[0].d) == "2026-06-08" and r[1].d is None and r[2].d is None
    assert str(r[3].ts) == "2026-06-08 01:00:00"


def test_degree_to_point(spark):
    df = spark.createDataFrame([(0.0,), (11.24,), (11.25,), (359.0,), (180.0,), (None,)], "d double")
    assert [r.p for r in df.select(C.degree_to_point("d").alias("p")).collect()] == ["N", "N", "NNE", "N", "S", "calm"]


def test_split_parts_and_urls(spark):
    df = spark.createDataFrame([("a·b·2020",), ("a·b",), ("a",)], "t string")
    a, p, d = clean.split_author_line(F.col("t"), "·")
    assert [tuple(r) for r in df.select(a, p, d).collect()] == [("a", "b", "2020"), ("a", "b", None), ("a", None, None)]
    u = spark.createDataFrame([("https://x.com/a/b/123", "/rel"), ("http://y.org/p", "http://z/abs")], "u string, l string")
    out = u.select(clean.url_tail(F.col("u")).alias("t"), clean.absolute_url(F.col("l"), clean.url_host(F.col("u"))).alias("a")).collect()
    assert [tuple(r) for r in out] == [("123", "https://x.com/rel"), ("p", "http://z/abs")]


def test_header_shift_explicit_schema(spark, tmp_path):
    p = tmp_path / "shifted.csv"
    p.write_text("a,b,c\n1,2,3,\n4,5,6,\n")
    from sparkpanel.sources.files import read_csv

    ok = read_csv(spark, str(p), "a int, b int, c int").collect()
    assert [tuple(r) for r in ok] == [(1, 2, 3), (4, 5, 6)]  # columns stay aligned
    with pytest.raises(Exception):
        read_csv(spark, str(p), "a int, b int, c int", mode="FAILFAST").collect()


def test_frequency_tokens_and_stop_words(spark):
    df = spark.createDataFrame([("<b>Hello</b> 및 세계 hello!! a 세계",)], "text string")
    got = sorted((r.token) for r in text.frequency_tokens(df, "text").collect())
    assert got == ["Hello", "hello", "세계", "세계"]


def _sk_tfidf(docs, vocab_size, min_len):
    """Plain numpy reference of the smooth-idf, L2-normalised, vocabulary-limited TF-IDF."""
    import re

    toks = [[t for t in re.findall(r"\w+", d.lower()) if len(t) >= min_len] for d in docs]
    cf = Counter(t for ts in toks for t in ts)
    vocab = [t for t, _ in sorted(cf.items(), key=lambda kv: (-kv[1], kv[0]))[:vocab_size]]
    n = len(docs)
    df_ = {t: sum(1 for ts in toks if t in ts) for t in vocab}
    idf = {t: math.log((1 + n) / (1 + df_[t])) + 1 for t in vocab}
    m = np.array([[Counter(ts)[t] * idf[t] for t in vocab] for ts in toks], dtype=float)
    norms = np.linalg.norm(m, axis=1)
    m = m / np.where(norms == 0, 1, norms)[:, None]
    return dict(zip(vocab, m.sum(axis=0)))


def test_tfidf_three_docs(spark):
    docs = ["the cat sat on the mat", "the dog sat", "a cat and a dog and a bird"]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)] + [(9, None)], "id int, t string")
    got = {r.term: r.score for r in text.tfidf_top(df, "id", "t", vocab_size=5, top=5).collect()}
    want = _sk_tfidf(docs, 5, 2)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-9)


HTML = [
    '<html><head><title> A page </title><meta property="og:description" content="first"></head></html>',
    '<html><head><meta name="description" content="second"><meta content="img.png" property="og:image"></head></html>',
    '<html><body><h1>only h1</h1><p>short</p><p>this paragraph is long enough &amp; fine</p></body></html>',
]


def test_html_meta_and_summary(spark):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(HTML)], "id int, html string")
    h = F.col("html")
    r = df.select(documents.page_title(h).alias("t"), documents.meta_content(h, "description", "og:description").alias("d"),
                  documents.meta_content(h, "og:image").alias("img")).collect()
    assert [x.t for x in r] == ["A page", "", ""]
    assert [x.d for x in r] == ["first", "second", None]
    assert [x.img for x in r] == [None, "img.png", None]
    s, det = documents.page_summary(h)
    out = df.select(s.alias("s"), det.alias("d")).collect()
    assert out[2].s == "this paragraph is long enough & fine" and out[2].d == []


def test_json_cards(spark):
    cards = ['{"price": {"amount": 12.5, "display_amount": "12,5"}, "n": 3, "f": 1.5, "b": true}',
             '{"price": 7, "n": "x"}', '{broken', None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cards)], "id int, raw string")
    r = df.select(*documents.amount_fields(F.col("raw"), ["price"])).collect()
    assert [(x.price_amount, x.price_display) for x in r] == [(12.5, "12,5"), (7.0, None), (None, None), (None, None)]
    types = {x.key: x.sql_type for x in documents.first_value_type(df, "raw", ["price", "n", "f", "b"], "id").collect()}
    assert types == {"price": "TEXT", "n": "INTEGER", "f": "REAL", "b": "INTEGER"}


def test_nested_flatten(spark):
    df = spark.createDataFrame([(1, {"a": 1, "b": {"c": "x"}})], "id int, p struct<a:int, b:struct<c:string>>")
    out = documents.flatten_struct(df, "p")
    assert out.columns == ["id", "p_a", "p_b_c"]


def test_meta_links_and_paragraphs_in_any_attribute_form(spark):
    from pyspark.sql import functions as F

    from sparkpanel.operators import documents as D

    html = ("<META content='first &amp; last' name=Description><meta name='og:image' content=\"\"><meta content=i.png property='og:image'/>"
            "<p class=\"x>y\">long enough paragraph</p><pre>not a p</pre><p>short</p>"
            "<a class=b href='/one'>One</a><a name=x>no link</a><a href=/two id=q>T&nbsp;wo</a>")
    df = spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")
    r = df.where("page_id = 1").select(D.meta_content(F.col("html"), "description").alias("d"), D.meta_content(F.col("html"), "og:image").alias("i"),
                                       D.paragraphs(F.col("html")).alias("p")).first()
    assert (r.d, r.i, r.p) == ("first & last", "i.png", ["long enough paragraph", "short"])
    assert [(x.link_no, x.href, x.link_text) for x in D.links(df, "page_id", "html").orderBy("link_no").collect()] == [(1, "/one", "One"), (2, "/two", "T\u00a0wo")]


def test_reviews_from_alternative_lists_and_unicode_blanks(spark):
    from pyspark.sql import functions as F

    from sparkpanel.operators import documents as D
    from sparkpanel.operators import text as X

    raw = ['{"commentList": [{"title": " a "}, {"title": "", "content": " "}]}', '{"comments": [{"body": "b"}]}', '{"subject": "c"}']
    df = spark.createDataFrame([(x,) for x in raw], "raw string").select(F.explode(D.review_records(F.col("raw"))).alias("raw"))
    title, content, _ = D.tolerant_reviews(F.col("raw"))
    got = df.select(title.alias("t"), content.alias("c")).where("t is not null or c is not null").collect()
    assert sorted((r.t or "", r.c or "") for r in got) == [("", "b"), ("a", ""), ("c", "")]
    words = X.frequency_tokens(spark.createDataFrame([("가나　다라 마바",)], "t string"), "t").collect()
    assert [r.token for r in words] == ["가나", "다라", "마바"]
