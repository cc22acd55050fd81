"""Token counts against the library, ranked search against brute force, on small tables."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

DOCS = "doc_id long, text string, n_tokens string, score string, rank string, query string"
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")


def docs_frame(spark, rows):
    """Rows of (id, text) beside columns that carry the operators' own names."""
    return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in rows], DOCS)


# ------------------------------------------------------------------ token counts

def odd_texts():
    rng = random.Random(5)
    parts = [*"aA's'tTéÉİßàb 12³½ \n\t日本é🙂\x1c\x85'_-ƻ×÷ǅ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'ll", "the ", " and"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(800)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_are_the_librarys(spark, name):
    from tokenizers import Tokenizer

    from sparkpanel.llm.token_counts import count_tokens

    path = public_tokenizers.path(name)
    texts = [None, "", " ", "one", "one", "word " * 50_000, "x" * 100_000, *odd_texts()]
    rows = [*enumerate(texts), (3, "one"), (None, "null id")]
    got = count_tokens(docs_frame(spark, rows), path, limit=40).collect()
    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for i, t in rows:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want[i, len((t or "").encode()), n, n > 40] += 1
    assert Counter(tuple(r) for r in got) == want
    empty = count_tokens(docs_frame(spark, []), path, limit=1)
    assert empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and empty.count() == 0


def test_every_proven_string_is_one_token_and_the_rest_is_not():
    from tokenizers import Tokenizer

    from sparkpanel.llm.token_counts import whole_tokens

    whole = whole_tokens(WORD_FILE)
    model = Tokenizer.from_file(WORD_FILE).model
    assert 30_000 < len(whole) < 49_408
    assert {"hello", "the", "!"} <= whole
    for w in sorted(whole)[::50]:
        assert len(model.tokenize(w)) == 1
    # a string inside words is in the vocabulary, but alone it ends a word and has to be merged
    assert all(len(model.tokenize(w)) > 1 for w in ("thlyouble", "zzzzq") if w not in whole)


def test_files_with_other_rules_are_refused(tmp_path):
    import json

    from sparkpanel.llm.token_counts import whole_tokens

    spec = json.load(open(WORD_FILE, encoding="utf-8"))
    spec["added_tokens"][0]["lstrip"] = True
    (tmp_path / "other.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="not supported"):
        whole_tokens(str(tmp_path / "other.json"))


# ------------------------------------------------------------------ ranked search

def brute_rank(docs, items, k):
    from sparkpanel.llm.lexical_search import terms_of

    bags = [(i, Counter(terms_of(t or ""))) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in dict.fromkeys((i, t or "") for i, t in items):
        scored = []
        for i, b in bags:
            m = 50 + (50 * sum(b.values()) * n_docs) // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 20 * m))
                        for t in set(terms_of(text)) if t in b)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def test_terms():
    from sparkpanel.llm.lexical_search import terms_of

    assert terms_of("Ab-cD_é1 ÀÉ\x7f\x00x y`Z[") == [b"ab", b"cd", "é1".encode(), "ÀÉ".encode(), "x y".encode(), b"z"]


@pytest.mark.parametrize("k", [1, 5, 50])
def test_rank_matches_brute_force(spark, k):
    from sparkpanel.llm.lexical_search import rank

    rng = random.Random(k)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.randint(1, 60))) for i in range(600)]
    copy = text(30)
    docs += [(1000 + i, copy) for i in range(200)] + [(2000, copy)] * 30  # ties and repeated rows
    docs += [(3000, None), (3001, ""), (3002, "-- !"), (None, text(40)), (3003, text(100_000))]
    items = [(i, text(rng.randint(1, 25))) for i in range(20)] + [(50, copy), (50, copy), (50, "w1 w2"), (51, None), (52, "nowhere"), (None, "w1")]
    got = rank(docs_frame(spark, docs).repartition(3), spark.createDataFrame(items, "item_id long, text string"), k=k).collect()
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == brute_rank(docs, items, k)


def test_rank_of_empty_tables(spark):
    from sparkpanel.llm.lexical_search import rank

    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, q in ((docs_frame(spark, []), items), (docs_frame(spark, [(1, "a")]), items.limit(0)), (docs_frame(spark, [(1, None)]), items)):
        out = rank(d, q)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_query_blocks_give_the_same_ranking(spark, monkeypatch):
    from sparkpanel.llm import lexical_search

    docs = [(i, f"a{i % 7} b{i % 5} c{i % 3}") for i in range(80)]
    items = [(i, f"a{i} b{i} c{i}") for i in range(9)]
    monkeypatch.setattr(lexical_search, "QUERY_TERMS", 4)
    got = lexical_search.rank(docs_frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), k=10).collect()
    assert Counter(map(tuple, got)) == brute_rank(docs, items, 10)


@pytest.mark.parametrize("window,block,k", [(4, 64, 3), (16, 200, 10), (1, 50, 1)])
def test_windows_are_skipped_without_losing_a_document(monkeypatch, window, block, k):
    """Small windows and blocks: thresholds rise, lists are skipped, and the k best stay exact."""
    from sparkpanel.llm import lexical_search as s

    monkeypatch.setattr(s, "WINDOW", window)
    rng = np.random.default_rng(window)
    weight = rng.integers(1, 9000, 40)
    best, asked, every = s.Best(k), sorted(rng.choice(40, 12, replace=False).tolist()), []
    n_docs, n_terms = 1000, 20_000
    for b in range(8):
        n = rng.integers(5, 40, block)
        held = [rng.choice(40, rng.integers(0, 20), replace=False, p=np.arange(40, 0, -1) / 820) for _ in range(block)]
        tfs = [rng.integers(1, 4, len(h)) for h in held]
        lists = s.Block(n, np.array([len(h) for h in held]), np.concatenate(held).astype(np.int32), np.concatenate(tfs), weight, n_docs, n_terms)
        lists.search(asked, best)
        best.close_block(pa.array(range(b * block, (b + 1) * block)))
        for i, (h, t) in enumerate(zip(held, tfs)):
            m = 50 + (50 * int(n[i]) * n_docs) // n_terms
            score = sum(int(weight[x]) * ((10**9 * int(y)) // (1000 * int(y) + 20 * m)) for x, y in zip(h, t) if x in asked)
            if score:
                every.append((-score, b * block + i))
    assert list(zip((-best.scores).tolist(), best.docs.to_pylist())) == sorted(every)[:k]
