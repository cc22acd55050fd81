"""Language ID, quality rules, line dedup, SimHash and packing against brute force on small tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


EDGE = [(1, None, "en", None, None), (2, "", None, "s", 0), (3, " \n\t ", "en", "s", 4), (4, "one", "en", "s", 3),
        (4, "one", "en", "s", 3), (None, "null id text", "en", "s", 1), (6, "word " * 30_000, "en", "s", 1)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ------------------------------------------------------------------ quality rules

def brute_base(text):
    w = words_of(text)
    seen, where = Counter(), defaultdict(list)
    for i in range(len(w) - 2):
        where[tuple(w[i:i + 3])].append(i)
    covered = {i + k for ps in where.values() if len(ps) > 1 for i in ps for k in range(3)}
    dup = 0
    for line in (text or "").split("\n"):
        if words_of(line):
            dup += seen[line] > 0
            seen[line] += 1
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))


def test_base_counts_match_brute_force(spark):
    from sparkpanel.llm.quality_lines import base_counts

    rng = random.Random(1)
    texts = ["".join(rng.choice(["a ", "b ", "ab\n", "# ", "\x0b", "é  ", "<|> ", "\n"]) for _ in range(rng.randint(0, 120)))
             for _ in range(150)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + EDGE
    got = base_counts(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_base(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_line_frequency_rejects_depleted_documents_only(spark):
    from sparkpanel.llm.quality_lines import judge

    rng = random.Random(2)
    own = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    boiler = [own(40), own(30)]
    rows, want = [], {}
    for i in range(60):
        mostly = i < 30
        parts = [boiler[0], boiler[1].upper() + "  ", own(20)] if mostly else [boiler[0], own(100)]
        rows.append((i, "\n".join(parts), "en", "hot", 1))
        want[i] = not mostly
    clean = own(80)
    for i in range(100, 200):  # exact copies count as one document
        rows.append((i, clean, "en", "hot", 1))
        want[i] = True
    rows.append((300, "\n".join([boiler[0], boiler[1], own(20)]), "en", "other host", 1))
    want[300] = True
    rows += [(i, "x y", "en", None, 1) for i in (400, 400)] + EDGE
    got = judge(frame(spark, rows), min_docs=20, share=0.01).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["kept"] for r in got if r["doc_id"] in want} == want
    assert next(r["n_removed_words"] for r in got if r["doc_id"] == 0) == 70
    assert not any(r["kept"] for r in got if r["doc_id"] in (1000, 400, 2))


def test_the_limit_acts_on_small_hosts_and_grows_slowly_on_large_ones(spark):
    """Boilerplate on a host of 30 texts, and beside it a host with a third of a percent of boilerplate."""
    from sparkpanel.llm.quality_lines import judge

    rng = random.Random(3)
    own = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    menu, footer = own(60), own(60)
    rows = [(i, f"{menu}\n{own(20)}" if i < 8 else own(80), "en", "small", 1) for i in range(30)]
    # 6,000 texts: 1 % is 60, the square root 77, and 70 texts hold the footer; 5 more texts hold another line
    rows += [(1000 + i, f"{footer}\n{own(55)}" if i < 70 else (f"{menu}\n{own(20)}" if i < 75 else own(52)), "en", "hot", 1) for i in range(6000)]
    rows += [(9000 + i, "x" * 300_000 + f" {own(60)}", "en", "long", 1) for i in range(2)]
    got = {r["doc_id"]: r for r in judge(docs_with_clashes(spark, rows)).collect()}
    assert [i for i in range(30) if not got[i]["kept"]] == list(range(8))
    assert [i for i in range(1000, 7000) if not got[i]["kept"]] == list(range(1000, 1070))
    assert got[9000]["kept"] and got[9001]["kept"]


def docs_with_clashes(spark, rows):
    """Documents with extra columns that carry names the operators use themselves."""
    extra = "kept string, base_failed string, line string, host string, doc string, key string, w string, text_hash string, n_words string"
    return spark.createDataFrame([(*r, *["x"] * 9) for r in rows], f"{DOCS}, {extra}")


# ------------------------------------------------------------------ line dedup

def brute_dedup(docs, min_words):
    """docs: sorted (id, text); returns id -> removed line numbers, by longest previous matches."""
    seq = []
    for d, (_, text) in enumerate(docs):
        seq += [(d, ln, x.strip(" \t\x0b\x0c\r")) for ln, x in enumerate((text or "").split("\n")) if x.strip(" \t\x0b\x0c\r")]
    gone = defaultdict(set)
    for i in range(len(seq)):
        best = 0
        for j in range(i):
            n = 0
            while i + n < len(seq) and seq[i + n][0] == seq[i][0] and seq[j + n][0] == seq[j][0] and seq[i + n][2] == seq[j + n][2]:
                n += 1
            best = max(best, n)
        if sum(len(words_of(seq[i + k][2])) for k in range(best)) >= min_words and best:
            for k in range(best):
                gone[seq[i + k][0]].add(seq[i + k][1])
    return gone


@pytest.mark.parametrize("seed,min_words", [(1, 3), (2, 5), (3, 8), (4, 2)])
def test_line_dedup_matches_brute_force(spark, seed, min_words):
    from sparkpanel.llm.line_dedup import dedup_lines

    rng = random.Random(seed)
    lines = ["a", "b c", "d e f", "  a ", "", "g"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14))) for _ in range(25)]
    texts += [texts[3], "\n".join(["x y"] * 9), texts[5] + "\n" + texts[6]]
    docs = list(enumerate(texts))
    gone = brute_dedup(docs, min_words)
    got = dedup_lines(frame(spark, [(i, t, "en", "s", 1) for i, t in docs]), min_words=min_words).collect()
    assert len(got) == len(docs)
    for r in got:
        ls = texts[r["doc_id"]].split("\n")
        want = "\n".join(x for k, x in enumerate(ls) if k not in gone[r["doc_id"]]) if gone[r["doc_id"]] else texts[r["doc_id"]]
        assert r["text"] == want, r["doc_id"]
        assert r["n_removed_lines"] == len(gone[r["doc_id"]])


def test_line_dedup_edge_rows_and_extra_columns(spark):
    from pyspark.sql import functions as F

    from sparkpanel.llm.line_dedup import dedup_lines

    df = frame(spark, EDGE).withColumn("gone", F.lit(1)).withColumn("pos", F.lit(2))
    got = dedup_lines(df).collect()
    assert len(got) == len(EDGE) and {r["pos"] for r in got} == {2}
    assert dedup_lines(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ SimHash

def brute_fingerprint(text, n=3):
    w = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) > n else [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_matches_brute_force():
    from sparkpanel.llm.simhash import fingerprint

    rng = random.Random(3)
    for t in [None, "", " \n", "A b", "A B c", "É x y", *(" ".join(rng.choice(["Aa", "b", "É", "d\x0be"]) for _ in range(rng.randint(1, 90))) for _ in range(60))]:
        assert fingerprint(t) == brute_fingerprint(t)


def brute_components(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ps = sorted(prints)
    for i, a in enumerate(ps):
        for b in ps[:i]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= 2:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    groups = defaultdict(set)
    for p in ps:
        groups[find(p)].add(p)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("max_bucket", [2, 16])
def test_links_give_the_components_of_all_pairs(spark, max_bucket):
    from sparkpanel.llm.simhash import components, links

    rng = random.Random(4)
    prints = {0, -1}
    for _ in range(8):
        c = rng.getrandbits(64)
        for _ in range(25):
            x = c
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            prints.add(x - 2**64 if x >= 2**63 else x)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = components(links(df, max_bucket=max_bucket)).collect()
    groups = defaultdict(set)
    for r in got:
        groups[r["root"]] |= {r["node"], r["root"]}
    # values that only the ball way adds are no fingerprints of the table
    mine = {frozenset(g & prints) for g in groups.values()}
    assert {g for g in mine if len(g) > 1} == {g for g in brute_components(prints) if len(g) > 1}


def test_near_duplicates_edge_rows(spark):
    from sparkpanel.llm.simhash import near_duplicates

    base = " ".join(f"w{i}" for i in range(400))
    rows = [*EDGE, (10, base, "en", "s", 1), (11, base, "en", "s", 1), (12, base + " tail", "en", "s", 1)]
    got = near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add(r["component_id"])
    assert by[1] == by[2] == by[3] == {1} and by[4] == {4} and by[10] == by[11] == {10} and by[None] == {None}
    assert near_duplicates(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ packing

def test_pieces_are_the_tokenizers_ids_and_sequences_are_gapless(spark):
    from tokenizers import Tokenizer

    from sparkpanel.llm.packing import pack_documents

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["Das", "thé", "x²", "日本", "<|endoftext|>", "\n", "don't", "a_b"]) for _ in range(rng.randint(0, 900))) for _ in range(60)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(900 + k, t, None, None, None) for k, (_, t, *_x) in enumerate(EDGE)]
    text_of = {r[0]: r[1] or "" for r in rows}
    got = pack_documents(frame(spark, rows), path, keep_ids=True).collect()
    bins, docs = defaultdict(list), defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append(r)
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    for d, parts in docs.items():
        parts.sort(key=lambda r: r["piece"])
        ids = tok.encode(text_of[d], add_special_tokens=False).ids + [2]
        assert [x for r in parts for x in r["ids"]] == ids
        assert [r["start"] for r in parts] == list(np.cumsum([0, *[r["length"] for r in parts[:-1]]]))
        assert all(r["length"] == 1024 for r in parts[1:])
    total = sum(r["length"] for r in got)
    assert set(docs) == set(text_of) and len(bins) <= -(-total // 1024) + 3
    assert pack_documents(frame(spark, []), path).count() == 0


def test_plan_uses_every_piece_once_and_is_near_the_bound():
    from sparkpanel.llm.packing import plan

    rng = np.random.default_rng(0)
    for draw in (rng.integers(1, 1025, 5000), (rng.lognormal(5, 1, 5000).astype(int) % 1024) + 1, np.full(100, 600), np.array([1])):
        counts = Counter(draw.tolist())
        p = plan(dict(counts))
        used = Counter()
        for lengths, times in p:
            assert sum(lengths) <= 1024 and times > 0
            for x in lengths:
                used[x] += times
        assert used == counts
    uniform = Counter(rng.integers(1, 1025, 5000).tolist())
    assert sum(n for _, n in plan(dict(uniform))) <= 1.03 * sum(k * v for k, v in uniform.items()) / 1024


# ------------------------------------------------------------------ language ID

def test_language_id_held_out_accuracy_and_edge_rows(spark):
    from sparkpanel.llm.language_id import identify, held_out

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify(docs.select("doc_id", "text", "lang")).withColumn("h", held_out()).where("h and lang is not null").collect()
    assert len(got) > 150 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"] for r in got} == {i for i in {r["doc_id"] for r in got} if zlib.crc32(str(i).encode()) % 4 == 2}


def test_language_id_backs_off_and_knows_no_letters(spark):
    from sparkpanel.llm.language_id import predict, train

    rows = [(1, "the house is here", "en", "s", 1), (2, "das haus ist hier", "de", "s", 1), (3, None, "en", "s", 1), (4, "zz", None, "s", 1)]
    model = train(frame(spark, rows))
    texts = [(1, "housing there", "x", "s", 1), (2, "hausen dasist", "x", "s", 1), (3, None, "x", "s", 1), (4, "12 ² _", "x", "s", 1), (5, "日本", "x", "s", 1), (5, "日本", "x", "s", 1), (6, "", "x", "s", 1)]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict(frame(spark, texts), model).collect()}
    assert got[1][0] == "en" and got[2][0] == "de"
    assert got[3] == got[4] == got[6] == ("und", 0.0) and got[5] == ("de", 0.5)
    assert predict(frame(spark, EDGE), train(frame(spark, []))).select("lang_pred").distinct().collect()[0][0] == "und"
    assert predict(frame(spark, []), model).count() == 0


def test_language_id_keeps_every_counted_token(spark):
    """60,000 words of a large language leave the words of a rarer one in place, also a word whose
    n-grams are those of the large one; languages beyond the five-hundredth are known."""
    from sparkpanel.llm.language_id import predict, train

    name = lambda i, alphabet: "".join(alphabet[i >> 4 * k & 15] for k in range(4))
    large, rare = "abcdefghijklmnop", "qrstuvwxyzäöüéèà"
    rows = [(i, " ".join(name(j, large) for j in range(i * 1000, i * 1000 + 1000)), "en", "s", 1) for i in range(60)] * 2
    rows += [(100, " ".join(name(j, rare) for j in range(10_000)) + " abcdmnop", "xx", "s", 1)]
    model = train(frame(spark, rows))
    texts = [(1, "abcdmnop", "x", "s", 1), (2, name(9_999, rare), "x", "s", 1), (3, name(59_999, large), "x", "s", 1)]
    got = {r["doc_id"]: r["lang_pred"] for r in predict(frame(spark, texts), model).collect()}
    assert got == {1: "xx", 2: "xx", 3: "en"}

    many = [(i, name(i, "bcdfghjklmnpqrst"), f"l{i:03}", "s", 1) for i in range(510)]
    got = predict(frame(spark, many), train(frame(spark, many))).collect()
    assert len(got) == 510 and all(r["lang"] == r["lang_pred"] for r in got)


def test_language_id_equals_plain_dictionaries_with_few_hot_words(spark, monkeypatch):
    from sparkpanel.llm import language_id
    from tests.llm.test_pipeline import brute_language, fixture_rows

    rows = fixture_rows()
    want = brute_language(rows)
    for hot in (3, 50_000):
        monkeypatch.setattr(language_id, "HOT_WORDS", hot)
        got = language_id.identify(frame(spark, rows)).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r["lang_pred"] == want[r["doc_id"]][0] and abs(r["score"] - want[r["doc_id"]][1]) < 1e-9


def test_simhash_links_of_fewer_bits(spark):
    from sparkpanel.llm.simhash import links

    fps = [0, 1, 3, 1 << 62, -1 << 63, (-1 << 63) + 1, 7 << 20]
    prints = spark.createDataFrame([(f,) for f in fps], "fp long")
    for bits in (0, 1):
        want = {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}
        assert {tuple(r) for r in links(prints, bits).collect()} == want


def test_language_words_of_many_texts_at_once_are_those_of_each(monkeypatch):
    """op10: words cut from whole chunks are the letter runs of every single text, wherever the chunks end."""
    import pyarrow as pa

    from sparkpanel.llm import language_id

    rng = random.Random(3)
    letters = [c for c in map(chr, rng.sample([*range(0xD800), *range(0xE000, 0x110000)], 3000))]
    texts = ["", "a", "İSTANBUL ΣΑΣ Σ", "x²y½ ٣ab_cd١e", "\n\nab\ncd\n", "ß ẞ ﬁ ǅ",
             "\U0001d49c\U00010400bc 漢字か", " x\x00y", "_a_", "7", "b" * 500]
    texts += ["".join(rng.choices([*letters, *"ab é ß1_ \n"], k=rng.randrange(60))) for _ in range(500)]
    words, place, text = language_id._cut_texts(texts)
    words, got = words.to_pylist(), [[] for _ in texts]
    for w, t in zip(place, text):
        got[t].append(words[w])
    assert got == [language_id.words_of(t) for t in texts] and len(set(words)) == len(words)
    langs = [rng.choice(["de", "en", "fr"]) for _ in texts]
    want = Counter((lang, w) for lang, t in zip(langs, texts) for w in language_id.words_of(t))
    for chunk, flush in ((1 << 20, 200_000), (1, 5), (300, 100)):
        monkeypatch.setattr(language_id, "_CHUNK", chunk)
        monkeypatch.setattr(language_id, "_FLUSH", flush)
        assert [t for part in language_id._chunks(texts) for t in texts[part]] == texts
        counts = Counter()
        for batch in language_id._count_words(pa.table({"lang": langs, "text": texts}).to_batches(max_chunksize=200)):
            for r in batch.to_pylist():
                counts[r["lang"], r["word"]] += r["n"]
        assert counts == want
