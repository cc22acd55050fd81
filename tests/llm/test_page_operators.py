"""WARC, URL filter, sharding, SentencePiece and nearest neighbours against brute force on small tables."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

PAGES = "page_id long, url string, html string"


# ------------------------------------------------------------------ WARC

def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.mark.parametrize("range_bytes", [97, 1 << 20])
def test_warc_round_trip(spark, tmp_path, range_bytes):
    from sparkpanel.llm.warc import read_warc, write_warc

    rng = random.Random(1)
    pages = [(i, f"http://h/{i} x\r\ny" if i % 5 else None, "".join(chr(rng.choice([65, 0x20AC, 10, 13, 0])) for _ in range(rng.randint(0, 3000)))) for i in range(60)]
    pages += [(100, "u", None), (101, "u", ""), (7, "again", "same"), (8, "again", "same"), (9, "again", "same"), (9, "again", "same"), (None, "n", "same"), (None, "n", "alone"),
              (200, "u", "z" * 3_000_000)]
    df = spark.createDataFrame(pages, PAGES).repartition(3)
    manifest = write_warc(df, str(tmp_path / "w"))
    got = read_warc(spark, manifest, range_bytes).collect()
    assert len(got) == len(pages) == sum(r["records"] for r in manifest.collect())
    smallest = {}
    for i, _, h in pages:
        if i is not None:
            smallest[h or ""] = min(smallest.get(h or "", i), i)
    left = sorted((-1 if i is None else i, len((h or "").encode()), b32((h or "").encode())) for i, _, h in pages)
    assert sorted((-1 if r["page_id"] is None else r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in got) == left
    html = {(i, b32((h or "").encode())): h or "" for i, _, h in pages}
    for r in got:
        text = html[r["page_id"], r["payload_digest"]]
        first = smallest.get(text)
        if first is None or first == r["page_id"]:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("response", None, text.encode())
        else:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", first, None)
    # any gzip reader can read the files
    whole = b"".join(gzip.open(r["path"]).read() for r in manifest.collect())
    assert whole.count(b"WARC/1.1\r\n") >= len(pages)


def test_warc_reader_skips_false_magic_and_rejects_damage(tmp_path):
    from sparkpanel.llm.warc import record_bytes, records_in

    # stored members make the payload's own bytes visible to the scan
    def stored(page, payload):
        data = gzip.decompress(record_bytes(page, "u", payload, None))
        pack = zlib.compressobj(0, zlib.DEFLATED, 31)
        return pack.compress(data) + pack.flush()

    fake = b"\x1f\x8b\x08 no member " + gzip.compress(b"not a record") + b"\x1f\x8b"
    raw = stored(1, fake) + b"\x1f\x8b\x08junk" + gzip.compress(b"") + stored(2, b"x" * 5000)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(raw)
    for size in (1, 50, 777, len(raw)):
        got = [r[2] for a in range(0, len(raw), size) for r in records_in(str(path), a, min(a + size, len(raw)))]
        assert got == [1, 2]
    path.write_bytes(raw[:-9])
    with pytest.raises((ValueError, zlib.error)):
        list(records_in(str(path), 0, len(raw)))


def test_warc_small_payloads_and_empty_table(spark, tmp_path):
    from sparkpanel.llm.warc import round_trip

    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], PAGES)
    got = {r["page_id"]: r["record_type"] for r in round_trip(spark, df, min_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert round_trip(spark, df.limit(0)).count() == 0


# ------------------------------------------------------------------ URL filter

def brute_url(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("small,prefix", [(True, 8), (False, 8), (True, 1), (False, 1)])
def test_url_filter_matches_brute_force(spark, monkeypatch, small, prefix):
    """With one digit in the key most expressions meet some rule: the full digests must throw them out."""
    from sparkpanel.llm import url_filter

    monkeypatch.setattr(url_filter, "PREFIX", prefix)
    if not small:
        monkeypatch.setattr(url_filter, "MAX_BROADCAST_ROWS", 0)
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.b", "", "block"), ("a.b", "/x/y", "allow"), ("b", "/x/", "block")]
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/x?q#f", "http://example.net/en", "http://net/", "http://net", "http://net?x/",
            "http://a.b/x/yz", "http://c.a.b", "http://xa.b/x/y", "http://b/x/", "https://É.NET/ü/://x", "x://a.b#://q", "http://u\nv.net/\n", "http://net:80/"]
    pages = [(i, u, "h") for i, u in enumerate(urls)] + [(3, "http://net/", "h"), (3, "http://net/", "h"), (None, "http://net/", "h")]
    r = spark.createDataFrame([*rules, rules[0]], "host string, path string, verdict string")
    got = url_filter.judge_urls(spark.createDataFrame(pages, PAGES), r).collect()
    want = [(i, *brute_url(u, rules)) for i, u, _ in pages]
    key = lambda t: tuple("" if x is None else str(x) for x in t)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    none = url_filter.judge_urls(spark.createDataFrame(pages, PAGES), r.limit(0)).collect()
    assert len(none) == len(pages) and {x["verdict"] for x in none} == {"allow"}
    assert url_filter.judge_urls(spark.createDataFrame([], PAGES), r).count() == 0


def test_url_filter_long_urls_and_clashing_names(spark):
    from sparkpanel.llm.url_filter import judge_urls

    rules = spark.createDataFrame([("b", "/x/", "block")], "host string, path string, verdict string")
    long = "http://" + "a." * 2000 + "b/x/" + "y" * 100_000
    rows = spark.createDataFrame([(1, long, "h", "r", "v", "k"), (2, None, "h", "r", "v", "k")],
                                 "page_id long, url string, host string, rule string, verdict string, key string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(rows, rules).collect()}
    assert got == {1: ("b/x/", "block"), 2: (None, "allow")}


# ------------------------------------------------------------------ sharding

def test_kd_shards_have_near_equal_bytes_and_gapless_slots(spark):
    from sparkpanel.llm.kd_shard import kd_shards

    rng = random.Random(2)
    rows = [(i, "x" * rng.choice([0, 5, 50, 500, 900]) + str(i), rng.choice(["en", "de", None]), f"s{min(5, int(rng.expovariate(1)))}") for i in range(1500)]
    rows += [(5000 + i, "copy of one text " * 20, "en", "s0") for i in range(1500)]
    rows += [(None, None, None, None), (1, rows[1][1], rows[1][2], rows[1][3])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for n in (8, 5):
        got = kd_shards(df, n_shards=n).collect()
        size, slots = defaultdict(int), defaultdict(list)
        for r in got:
            size[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        assert len(got) == len(rows) and set(size) == set(range(n))
        mean = sum(size.values()) / n
        assert max(size.values()) <= 1.06 * mean and min(size.values()) >= 0.94 * mean
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by = {r["doc_id"]: r for r in got}
    assert by[5000]["size"] == 341 and by[5000]["text_crc32"] == zlib.crc32(("copy of one text " * 20).encode())
    assert (by[None]["size"], by[None]["text_crc32"]) == (1, 0)


def test_kd_shards_keep_light_copies_together_and_follow_target_bytes(spark):
    from sparkpanel.llm.kd_shard import kd_shards

    rng = random.Random(3)
    texts = [f"text {i} " * rng.randint(1, 9) for i in range(800)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = kd_shards(df, target_bytes=10_000).collect()
    total = sum(r["size"] for r in got)
    assert len({r["shard"] for r in got}) == -(-total // 10_000)
    where = defaultdict(set)
    for r in got:
        where[r["text_crc32"]].add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) <= 3
    assert kd_shards(df.limit(0), n_shards=4).count() == 0


@pytest.mark.parametrize("copies,others,size", [(500, 1000, 900), (500, 1000, 100), (40, 0, 30), (3, 200, 40)])
def test_kd_shards_keep_their_law_on_repeated_rows(spark, copies, others, size):
    """Rows that are equal in every column are dealt to as many shards as their bytes need."""
    from sparkpanel.llm.kd_shard import kd_shards

    rng = random.Random(copies)
    rows = [(7, "r" * size, "en", "s", "x", "x")] * copies
    rows += [(100 + i, "".join(rng.choice("ab") for _ in range(99)), rng.choice(["en", "de"]), "s", "x", "x") for i in range(others)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard string, size string")
    got = kd_shards(df, n_shards=8).collect()
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean, most = sum(sizes.values()) / 8, max(r["size"] for r in got)
    assert len(got) == len(rows) and set(sizes) == set(range(8))
    assert max(sizes.values()) <= 1.06 * mean + most and min(sizes.values()) >= 0.94 * mean - most
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def brute_kd(points, n_dims, n_shards, tolerance=0.005):
    """The k-d rule on lists: widest dimension, weighted median, whole values where a cut near the share
    allows it, else by text, else by row."""
    def width(rows, d):
        return max(p["x"][d] for p in rows) - min(p["x"][d] for p in rows)

    whole = [width(points, d) or 1.0 for d in range(n_dims)]

    def left_side(rows, keys, want, slack):
        """Rows that stay left: whole values of the first key, the crossing value by the next one."""
        taken = 0
        for value in sorted({keys[0](p) for p in rows}):
            group = [p for p in rows if keys[0](p) == value]
            size = sum(p["size"] for p in group)
            if taken + size >= want:
                under = [p for p in rows if keys[0](p) < value]
                if abs(want - taken - size) <= slack:
                    return under + group
                if abs(want - taken) <= slack and taken > 0:
                    return under
                return under + group if len(keys) == 1 else under + left_side(group, keys[1:], want - taken, slack)
            taken += size

    def split(rows, first, shards):
        if shards == 1 or not rows:
            for p in rows:
                p["shard"] = first
            return
        dim = max(range(n_dims), key=lambda d: (width(rows, d) / whole[d], -d))
        total = sum(p["size"] for p in rows)
        want = max(1, total * (shards // 2) // shards)
        left = left_side(rows, [lambda p: p["x"][dim], lambda p: p["text"], lambda p: p["row"]], want, max(1, int(total * tolerance)))
        ids = {p["row"] for p in left}
        split(left, first, shards // 2)
        split([p for p in rows if p["row"] not in ids], first + shards // 2, shards - shards // 2)

    split(points, 0, n_shards)
    return {p["row"]: p["shard"] for p in points}


@pytest.mark.parametrize("seed,n_shards", [(1, 2), (2, 8), (3, 5), (4, 7)])
def test_kd_tree_equals_brute_force(spark, seed, n_shards):
    from sparkpanel.llm.common import materialise
    from sparkpanel.llm.kd_shard import assign

    rng = random.Random(seed)
    points = []
    for i in range(400):
        text = rng.randrange(60) if i % 3 else 0  # a third of the rows shares one text
        points.append({"row": (i * 2654435761) % 2 ** 40 - 2 ** 39 << 20, "text": (text * 40503 % 997 - 500) << 50, "size": 50 + text,
                       "x": (rng.choice([0.0, 0.25, 1.0]) if text else 0.25, rng.randrange(6) / 8.0, math.log2(50 + text))})
    df = spark.createDataFrame([(p["size"], p["text"], p["row"], *p["x"]) for p in points],
                               "size long, text_hash long, row_hash long, d0 double, d1 double, log_size double")
    got = {r["row_hash"]: r["shard"] for r in assign(materialise(df, "points"), ["d0", "d1", "log_size"], n_shards).collect()}
    assert got == brute_kd(points, 3, n_shards)


# ------------------------------------------------------------------ SentencePiece

def brute_viterbi(model, word):
    table = {}
    for keys, ids, scores, chars in model.tables.values():
        for i, s, c in zip(ids, scores, chars):
            table["".join(map(chr, c))] = (int(i), float(s))
    best, back = [0.0] + [-math.inf] * len(word), [None] * (len(word) + 1)
    for end in range(1, len(word) + 1):
        for start in range(end):  # earlier starts first: an equal sum keeps the longer piece
            got = table.get(word[start:end])
            if got and best[start] + got[1] > best[end]:
                best[end], back[end] = best[start] + got[1], (start, got[0])
        if word[end - 1] not in table and best[end - 1] + model.unknown_score > best[end]:
            best[end], back[end] = best[end - 1] + model.unknown_score, (end - 1, -end)
    out, at = [], len(word)
    while at:
        out.append(back[at][1])
        at = back[at][0]
    return out[::-1]


def test_viterbi_matches_brute_force_and_round_trips(spark):
    from sparkpanel.llm.sentencepiece_viterbi import Encoder, decode_documents, encode_documents, segment

    path = public_tokenizers.path("piece_bpe_32k.model")
    enc = Encoder(path)
    words = ["▁the", "▁international", "▁▁▁x", "▁日本語", "▁a\nb", "é", "▁\x00", "▁naïveté", "▁qqqqzzzz", "▁ x"]
    for w in words:
        chars = np.array([[ord(c) for c in w]], dtype=np.uint32)
        ids, none = segment(enc.model, chars)
        assert ids[ids != none].tolist() == brute_viterbi(enc.model, w), w
    text = "the cat's naïve qqzz, 日本 (x)\n\tend."
    whole = brute_viterbi(enc.model, "▁" + text.replace(" ", "▁"))
    assert [x for x in enc.encode([text])[0].tolist() if enc.model.byte_of[x] < 0] == [x for x in whole if x >= 0]
    rng = random.Random(6)
    texts = ["", " ", "  a  b ", "▁ ▁", "\x00 ▁", "𝔘 日本 \n\t é", "x" * 3000, *("".join(rng.choice("the cat ▁é日\n") for _ in range(60)) for _ in range(30))]
    for t, ids in zip(texts, enc.encode(texts)):
        assert enc.decode(ids) == t
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "the", "the"])], "doc_id long, text string")
    ids = encode_documents(df, path)
    back = {r["doc_id"]: r["text"] for r in decode_documents(ids, path).collect()}
    assert back == {i: t or "" for i, t in enumerate([*texts, None, "the", "the"])}
    assert encode_documents(df.limit(0), path).count() == 0


def test_viterbi_matches_the_librarys_unigram_search(tmp_path):
    """The library's lattice search over the same file, its algorithm field set to unigram, gives the same ids."""
    import sentencepiece
    from sparkpanel.llm.sentencepiece_viterbi import Encoder

    path = public_tokenizers.path("piece_bpe_32k.model")
    raw = open(path, "rb").read()

    def fields(data):
        at = 0
        def varint():
            nonlocal at
            v = s = 0
            while True:
                b = data[at]
                at += 1
                v |= (b & 127) << s
                s += 7
                if b < 128:
                    return v
        while at < len(data):
            start, tag = at, varint()
            kind = tag & 7
            if kind == 0:
                varint()
            elif kind == 2:
                n = varint()
                at += n
            else:
                at += {1: 8, 5: 4}[kind]
            yield tag >> 3, start, at

    def length(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    parts = []
    for number, a, b in fields(raw):
        if number != 2:
            parts.append(raw[a:b])
            continue
        inner = next(raw[a + skip:b] for skip in range(2, 6) if length(b - a - skip) == raw[a + 1:a + skip])
        kept = b"".join(inner[x:y] for n, x, y in fields(inner) if n != 3) + b"\x18\x01"
        parts.append(b"\x12" + length(len(kept)) + kept)
    sp = sentencepiece.SentencePieceProcessor(model_proto=b"".join(parts))
    enc = Encoder(path)
    rng = random.Random(8)
    texts = ["the international community", "Der schöne Tag", "naïveté 日本", *(" ".join("".join(rng.choice("abcdeth") for _ in range(rng.randint(1, 9))) for _ in range(8)) for _ in range(50))]
    for t, ids in zip(texts, enc.encode(texts)):
        want = sp.nbest_encode_as_ids(t, 3)[0]
        score = lambda x: sum(sp.get_score(i) for i in x)
        assert ids.tolist() == want or score(ids.tolist()) == score(want), t


# ------------------------------------------------------------------ nearest neighbours

def test_search_matches_brute_force(spark):
    from sparkpanel.llm.ann import search

    rng = np.random.default_rng(0)
    centre = rng.standard_normal((6, 24))
    vectors = [(int(i), (centre[i % 6] + 0.5 * rng.standard_normal(24)).astype(np.float32).tolist()) for i in range(900)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(300)]  # copies, a query among them
    bad = [(2000, None), (2100, [0.0] * 24), (2200, [float("nan")] * 24), (2300, [float("inf")] + [1.0] * 23), (2400, [None] + [1.0] * 23), (None, vectors[0][1])]
    df = spark.createDataFrame([*vectors, *bad, vectors[3]], "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in search(df, lambda i: i % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    data = {i: np.array(v, dtype=np.float64) for i, v in vectors}
    wanted = [i for i in data if i % 50 == 0]
    assert set(got) == set(wanted)
    hits = 0
    for q in wanted:
        near = sorted((float(np.sqrt(((data[q] - v) ** 2).sum())), i) for i, v in data.items() if i != q)[:10]
        assert [r for r, _, _ in got[q]] == list(range(1, 11))
        assert all(abs(s - float(np.sqrt(((data[q] - data[i]) ** 2).sum()))) < 1e-9 for _, i, s in got[q])
        hits += len({i for _, i in near} & {i for _, i, _ in got[q]})
    assert hits >= 0.99 * 10 * len(wanted)
    assert got[1000][0][1] == 7 and [i for _, i, _ in got[1000]][1:] == list(range(1001, 1010))
    few = search(df.where("vec_id in (0, 1, 2, 2000)"), lambda i: i == 0).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2]
    assert search(df.limit(0), lambda i: i == 0).count() == 0


def test_recall_on_the_given_table(spark):
    from sparkpanel.llm.queries import QUERIES

    t = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    data = {r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in t}
    got = defaultdict(list)
    for r in QUERIES["op9_nearest_neighbours"](spark, "/root/testdata/sf0.01").orderBy("rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    for q, ids in got.items():
        near = sorted((float(np.sqrt(((data[q] - v) ** 2).sum())), i) for i, v in data.items() if i != q)[:10]
        assert ids == [i for _, i in near]
    assert len(got) == sum(i % 100 == 0 for i in data)


def test_nearest_keeps_the_best_over_many_batches(monkeypatch):
    """Small products and reranking chunks: thresholds fall, ties at the limit go to the smaller id."""
    import pyarrow as pa

    from sparkpanel.llm import ann

    monkeypatch.setattr(ann, "ROWS", 16)
    monkeypatch.setattr(ann, "PAIRS", 10)
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.integers(-2, 3, (300, 7)).astype(float), rng.standard_normal((300, 7)) * 1e3])
    ids, centre = rng.permutation(600), data.mean(axis=0)
    wanted = np.concatenate([data[:20], rng.standard_normal((5, 7))])
    code, norm, dot = ann.codes_of(data, centre, ann.rotation(7))
    table = pa.record_batch({"v": data.tolist(), "ids": [[int(i)] for i in ids], "code": [c.tobytes() for c in code], "norm": norm, "dot": dot})
    nearest = ann.Nearest(wanted, centre, 9)
    for at in range(0, 600, 150):
        nearest.see(table.slice(at, 150))
    for q, w in enumerate(wanted):
        every = sorted(zip(np.sqrt(((data - w) ** 2).sum(axis=1)).tolist(), ids.tolist()))[:9]
        got = sorted((s, i[0]) for s, i, j in zip(nearest.score.tolist(), nearest.ids.to_pylist(), nearest.query) if j == q)
        assert got == every


def test_search_with_clashing_names_and_two_dimensions(spark):
    from sparkpanel.llm.ann import search

    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(5 if i % 2 else 3).tolist(), "x", "x", "x", "x", "x") for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, query string, score string, rank string, dim string, ids string")
    got = search(df, lambda i: i % 10 < 2, k=4)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    by = defaultdict(list)
    for r in got.collect():
        by[r["query_id"]].append((r["score"], r["vec_id"]))
    for q in [i for i in range(80) if i % 10 < 2]:
        near = sorted((float(np.sqrt(((np.array(rows[q][1]) - np.array(v)) ** 2).sum())), i) for i, v, *_ in rows if i % 2 == q % 2 and i != q)[:4]
        assert [i for _, i in sorted(by[q])] == [i for _, i in near]
