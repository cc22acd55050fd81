"""Every operator and pipeline stage on nulls, empty and very long texts, ties, repeated rows, empty tables and
extra columns that carry the operators' own names."""

import public_tokenizers
import pytest

#: names that the operators use inside or return
NAMES = ["row", "key", "doc", "id", "h", "fp", "text_hash", "copies", "node", "root", "piece", "start", "length", "ids", "lang_pred", "score", "kept",
         "n_words", "ln", "w", "rid", "own", "best", "p", "host", "path", "rule", "verdict", "size", "shard", "slot", "digest", "refers_to", "__row", "__b", "__n"]
BASE = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 997}" for i in range(20_000))
TEXT = "the river walks under seven green lamps and a stone window " * 8
ROWS = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t\n ", "en", "s", 5), (4, TEXT, "en", "s", len(TEXT)), (4, TEXT, "en", "s", len(TEXT)),
        (5, TEXT, "en", "t", len(TEXT)), (None, TEXT + "x", None, None, None), (6, LONG, "en", "s", len(LONG)), (7, "日本 \U0001f642 İ", "en", "s", 6),
        (8, "x" * 20_000, "en", "s", 20_000)]


def docs(spark, rows=ROWS):
    extra = ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame([(*r, *["clash"] * len(NAMES)) for r in rows], f"{BASE}, {extra}")


def operators():
    from sparkpanel.llm import kd_shard, language_id, line_dedup, packing, quality_lines, sentencepiece_viterbi, simhash, token_counts

    byte_bpe, pieces, words = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
    return {"1": lambda d: packing.pack_documents(d, byte_bpe), "2": quality_lines.judge, "4": line_dedup.dedup_lines,
            "5": simhash.near_duplicates, "5 one": simhash.one_of_each, "7": lambda d: kd_shard.kd_shards(d, n_shards=3),
            "8": lambda d: sentencepiece_viterbi.round_trip(d, pieces), "8 ids": lambda d: sentencepiece_viterbi.encode_documents(d, pieces),
            "10": language_id.identify, "10 clear": lambda d: language_id.identify(d, clear=True), "11": lambda d: token_counts.count_tokens(d, words, 10)}


ONE_PER_ROW = ["2", "4", "5", "7", "8", "8 ids", "10", "10 clear", "11"]


@pytest.mark.parametrize("name", ["1", "2", "4", "5", "5 one", "7", "8", "8 ids", "10", "10 clear", "11"])
def test_document_operators(spark, name):
    op = operators()[name]
    got = op(docs(spark)).collect()
    plain = op(docs(spark).select("doc_id", "text", "lang", "source", "n_chars")).collect()
    ids = sorted(str(r[0]) for r in ROWS)
    if name in ONE_PER_ROW:
        assert sorted(str(r["doc_id"]) for r in got) == ids
    else:
        assert {str(r["doc_id"]) for r in got} <= set(ids)
    shared = [c for c in plain[0].__fields__ if c not in NAMES or c in ("score", "kept", "n_words", "size", "shard", "piece", "length", "fp")]
    unstable = {"sequence_id", "offset", "slot", "shard"} if name in ("1", "7") else {"root"}
    pick = lambda rows: sorted(str([r[c] for c in shared if c not in unstable]) for r in rows)
    assert pick(got) == pick(plain)
    assert op(docs(spark, [])).count() == 0


def test_one_of_each_is_determined_by_all_columns(spark):
    from sparkpanel.llm import simhash

    rows = [(4, TEXT, lang, "s", n) for n, lang in enumerate(["en", "de", None, "fr"])]
    kept = {tuple(simhash.one_of_each(spark.createDataFrame(r, BASE)).first()) for r in (rows, rows[::-1], rows[2:] + rows[:2])}
    assert len(kept) == 1


@pytest.mark.parametrize("stage", range(4))
def test_pipeline_stages(spark, stage):
    import corpus_pipeline

    name, run = corpus_pipeline.STAGES[stage]
    d = docs(spark)
    out = run(spark, d, "")
    assert out.columns == d.columns, name
    rows = out.collect()
    assert all(r[n] == "clash" for r in rows for n in NAMES)
    whole = {(r[0], r[1]) for r in ROWS}
    assert {(r["doc_id"], r["text"]) for r in rows} <= whole or name == "line_dedup"
    plain = run(spark, d.select("doc_id", "text", "lang", "source", "n_chars"), "").collect()
    assert sorted(str(r[:5]) for r in map(tuple, rows)) == sorted(str(tuple(r)) for r in plain)


def test_warc_with_clashing_names_and_long_pages(spark):
    from sparkpanel.llm.warc import round_trip

    rows = [(1, "http://a/", "p" * 300_000), (2, None, None), (2, None, None), (None, "http://a/", "p" * 300_000), (3, "", "")]
    extra = ", ".join(f"`{n}` string" for n in [*NAMES, "html_digest", "payload_bytes", "bytes"])
    df = spark.createDataFrame([(*r, *["clash"] * (len(NAMES) + 3)) for r in rows], f"page_id long, url string, html string, {extra}")
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in round_trip(spark, df, range_bytes=50_000).collect())
    assert got == sorted([("1", 300_000, "response", None), ("2", 0, "response", None), ("2", 0, "response", None), ("None", 300_000, "revisit", 1), ("3", 0, "revisit", 2)])


def test_search_and_trie_with_clashing_names(spark):
    from sparkpanel.llm import lexical_search, prefix_trie

    items = spark.createDataFrame([(1, "river stone", "c", "c")], "item_id long, text string, query string, doc string")
    got = lexical_search.rank(docs(spark), items, k=3).collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 4), (2, 4), (3, 5)]
    extra = ", ".join(f"`{n}` string" for n in NAMES if n not in ("conv_id", "turn", "role", "text"))
    n = len(NAMES)
    turns = spark.createDataFrame([(100, 1, "user", "a", *["c"] * n), (200, 1, "user", LONG, *["c"] * n)], f"conv_id long, turn long, role string, text string, {extra}")
    assert prefix_trie.prefix_trie(turns).count() == 3
