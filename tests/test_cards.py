"""Records from repeated blocks of pages: nesting, malformed markup, nulls."""

import random
import time
from html.parser import HTMLParser

import pytest

from sparkpanel.operators.cards import Field, Scanner, Selector, page_records

CARD = [Field("id", ("@data-product-id", "@id")), Field("sku", ("div[itemprop=sku]@content",)), Field("title", ("a.product-link@title",)),
        Field("price", ("span.price",), "none"), Field("deep", ("div.info b i",))]


def scan(page, record="div.product", fields=CARD):
    return Scanner(record, fields).records(page)


def test_fields_fallbacks_and_defaults():
    page = ("<div class='x product' ID=pid_3 data-product-id=''><div itemprop=\"sku\" content='S&amp;1'></div>"
            "<a title='T > 1' class=\"big product-link\">n</a><span class=price> 3 &euro;\n<b>0</b><br>x</span><span class=price>4</span>"
            "<div class=info><b><i>it<i>al</i>ic</i></b></div></div>")
    assert scan(page) == [["pid_3", "S&1", "T > 1", "3 € 0x", "italic"]]
    assert scan("<div class=product>") == [[None, None, None, "none", None]]
    assert scan("") == scan("no markup < at all") == scan("<div class=products>") == []


def test_records_inside_records_and_comments():
    page = ("<!-- <div class=product> --><script>'<div class=product>'</script><style><div class=product></style>"
            "<div class=product id=1><p>a<div class=product id=2><span class=price>2</span></div></div><div class=product id=3/>")
    assert [(r[0], r[3]) for r in scan(page)] == [("1", "2"), ("2", "2"), ("3/", "none")]


def test_malformed_markup_has_one_reading():
    items = lambda page: [r[0] for r in scan(page, "li", [Field("t", ("b",))])]
    assert items("<ul><li><b>1<li><b>2</ul></b><li><b>3") == ["1", "2", "3"]
    assert items("<ul><li><b>1<ul><li><b>in</ul>out</b></li></ul>") == ["1inout", "in"]
    assert items("</li></ul><li></x><b>4</b>5") == ["4"]
    assert scan("<p id=1>a<p id=2>b<br>c<table><tr><td id=3>d<td id=4>e", "p", [Field("i", ("@id",))]) == [["1"], ["2"]]
    assert scan("<tr><td id=3>d<td id=4>e<tr><td id=5>", "td", [Field("i", ("@id",))]) == [["3"], ["4"], ["5"]]


def test_selectors_take_ancestors_in_order():
    page = "<div class=a><i class=c>1</i><div class=b><div><i class='c d' x=1>2</i></div></div></div>"
    one = lambda s: scan(f"<u>{page}</u>", "u", [Field("t", (s,))])[0][0]
    assert [one(s) for s in ("i", ".a .b i", ".b .a i", "div i.d.c", "i[x]", "i[x=1]", "i[x=2]", "* * * .c")] == ["1", "2", None, "2", "2", "2", None, "2"]
    for bad in ("a > b", "a,b", "a:first"):
        with pytest.raises(ValueError, match="selector"):
            Selector(bad)


class _Tree(HTMLParser):
    """Texts of all <b> inside <div class=k> of well-formed pages, by the standard parser."""

    def __init__(self):
        super().__init__()
        self.path, self.out = [], []

    def handle_starttag(self, tag, attrs):
        self.path.append((tag, dict(attrs).get("class")))
        if self.path[-1] == ("div", "k"):
            self.out.append([len(self.path), None, True])
        if tag == "b":
            for r in self.out:
                if r[2] and r[1] is None:
                    r[1] = (len(self.path), [])

    def handle_endtag(self, tag):
        for r in self.out:
            if r[2] and r[1] and r[1][0] == len(self.path):
                r[1] = (10**9, r[1][1])
            if r[2] and r[0] == len(self.path):
                r[2] = False
        self.path.pop()

    def handle_data(self, data):
        for r in self.out:
            if r[2] and r[1] and r[1][0] <= len(self.path):
                r[1][1].append(data)


def test_well_formed_pages_agree_with_a_tree_reader():
    rng = random.Random(4)

    def inside(depth):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice(["x", " y ", "&lt;z", ""])
        tag = rng.choice(["div class=k", "div", "b", "i"])
        return "".join(f"<{tag}>{inside(depth - 1)}</{tag.split()[0]}>" + rng.choice(["", "t"]) for _ in range(rng.randint(0, 3)))

    for _ in range(300):
        page = inside(6)
        tree = _Tree()
        tree.feed(page)
        tree.close()
        want = [" ".join("".join(r[1][1]).split()) or None if r[1] else None for r in tree.out]
        assert [r[0] for r in scan(page, "div.k", [Field("t", ("b",))])] == want, page


def test_hostile_pages_take_time_in_proportion():
    for page in ("<b>" * 20_000 + "<div class=product id=1>" + "<i>" * 20_000, "<a href=" + "'x" * 100_000, "<a " * 100_000, "<!--" * 50_000,
                 "<script>" * 50_000, "<" * 200_000, "</z>" * 20_000 + "<i>" * 20_000 + "</z>" * 20_000 + "<p>" * 20_000):
        start = time.perf_counter()
        scan(page)
        assert time.perf_counter() - start < 10


def test_page_records_rows(spark):
    rows = [(1, "<ul><li><a href='/x'>X</a><li>none</ul>", "h"), (2, None, "h"), (3, "", "h"), (None, "<li><a href=/n>N</a>", "h"),
            (1, "<ul><li><a href='/x'>X</a><li>none</ul>", "h")]
    df = spark.createDataFrame(rows, "page_id long, html string, href string")
    fields = [Field("href", ("a@href",)), Field("label", ("a",), "?")]
    got = sorted(map(tuple, page_records(df, "page_id", "html", "li", fields).collect()), key=str)
    assert got == sorted([(1, 1, "/x", "X"), (1, 2, None, "?")] * 2 + [(None, 1, "/n", "N")], key=str)
    assert page_records(df.limit(0), "page_id", "html", "li", fields).count() == 0
