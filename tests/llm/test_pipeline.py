"""The corpus pipeline against a plain Python version on a small table; registration of the queries."""

import importlib.util
import math
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from tests.llm.test_text_operators import DOCS, brute_base, brute_components, brute_dedup, brute_fingerprint


def fixture_rows():
    rng = random.Random(11)
    vocab = {"en": ["the", "house", "river", "walks", "green", "under", "seven", "stone", "lamp", "window"],
             "de": ["das", "haus", "fluss", "geht", "unter", "sieben", "stein", "lampe", "fenster", "schnell"]}

    def text(lang, lines, words):
        return "\n".join(" ".join(rng.choice(vocab[lang]) + rng.choice(["", "n", "s", str(rng.randrange(900))]) for _ in range(words)) for _ in range(lines))

    rows = []
    for i in range(60):
        lang = rng.choice(["en", "de"])
        rows.append([i, text(lang, rng.randint(1, 6), rng.randint(12, 40)), lang, f"src{i % 3}"])
    passage = text("en", 2, 30)
    for i in (4, 9, 14):
        rows[i][1] += "\n" + passage
    for i in range(60, 66):  # exact and near copies
        rows.append([i, rows[i - 60][1] + (" tail" if i % 2 else ""), rows[i - 60][2], "src0"])
    rows += [[70, None, "en", "src1"], [71, "12 34 !!", "en", "src1"], [72, "", None, "src1"], [73, "same words again " * 40, "en", "src2"],
             [74, rows[0][1], "en", "src0"], [74, rows[0][1], "en", "src0"], [75, text("en", 4, 400), None, None]]
    return [(i, t, lg, s, len(t) if t is not None else None) for i, t, lg, s in rows]


def brute_language(rows):
    """Predicted language and score by plain dictionaries (few enough tokens for the model's bounds)."""
    words = lambda t: [w for w in re.findall(r"[^\W\d_]+", (t or "").lower())]
    grams = lambda w, n: [s[i:i + n] for s in [w if n == 1 else f"\x02{w}\x03"] for i in range(len(s) - n + 1)]
    counts = {n: defaultdict(Counter) for n in range(5)}
    for i, t, lang, *_ in rows:
        if lang is not None and t is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            for w in words(t):
                counts[0][lang][w] += 1
                for n in range(1, 5):
                    counts[n][lang].update(grams(w, n))
    langs = sorted(counts[0])
    size = {n: len(set().union(*counts[n].values())) for n in counts}

    def logs(n, token):
        return [math.log((counts[n][lg][token] + 0.5) / (sum(counts[n][lg].values()) + 0.5 * (size[n] + 1))) for lg in langs]

    out = {}
    for i, t, *_ in rows:
        total, seen = [0.0] * len(langs), False
        for w in words(t):
            seen = True
            if any(counts[0][lg][w] for lg in langs):
                found = [logs(0, w)]
            else:
                found = next((f for n in range(4, 0, -1) if (f := [logs(n, g) for g in grams(w, n) if any(counts[n][lg][g] for lg in langs)])), [])
            for f in found:
                total = [a + b / len(found) for a, b in zip(total, f)]
        top = max(total)
        share = 1 / sum(math.exp(x - top) for x in total)
        out[i] = (langs[total.index(top)], share) if seen else ("und", 0.0)
    return out


def brute_quality(rows):
    lines, hosts = defaultdict(set), defaultdict(set)
    norm = lambda t: [re.sub("[ \t\x0b\f\r]+", " ", x.lower()).strip(" ") for x in (t or "").split("\n")]
    for _, t, _, s, _ in rows:
        hosts[s].add(t)
        for x in norm(t):
            if x:
                lines[s, x].add(t)
    kept = []
    for r in rows:
        n, _, _, _, rep = brute_base(r[1])
        gone = sum(len(x.split(" ")) for x in norm(r[1]) if x and len(lines[r[3], x]) > max(5, min(0.01 * len(hosts[r[3]]), math.sqrt(len(hosts[r[3]])))))
        if n >= 50 and 100 * rep <= 50 * n and gone <= 0.5 * n:
            kept.append(r)
    return kept


def test_pipeline_matches_brute_force(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    rows = fixture_rows()
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    language = brute_language(rows)
    left = [r for r in rows if language[r[0]][0] != "und" and language[r[0]][1] >= 0.5]
    left = brute_quality(left)
    docs = sorted({(r[0], r[1]) for r in left})
    gone = brute_dedup(docs, 50)
    clean = {}
    for k, (i, t) in enumerate(docs):
        clean[i] = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[k]) if gone[k] else t
    clean = {i: t for i, t in clean.items() if re.search(r"[^ \t-\r]", t)}
    prints = {i: brute_fingerprint(t) for i, t in clean.items()}
    by_print = defaultdict(list)
    for i, p in prints.items():
        by_print[p].append(i)
    keep = {min(i for p in g for i in by_print[p]) for g in brute_components(set(prints.values()))}

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts = defaultdict(list)
    for r in got:
        parts[r["doc_id"]].append(r)
    assert set(parts) == keep and 70 not in keep and 73 not in keep and not keep & {60, 62, 64, 74}
    for i, ps in parts.items():
        ids = tok.encode(clean[i], add_special_tokens=False).ids + [2]
        assert sum(p["length"] for p in ps) == len(ids)
        for p in ps:
            raw = b"".join(x.to_bytes(4, "little") for x in ids[p["start"]:p["start"] + p["length"]])
            assert zlib.crc32(raw) == p["ids_crc32"]
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        ends = [0]
        for offset, length in sorted(b):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 1024


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame(fixture_rows()[:20], DOCS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns, name
        assert stage(spark, docs.limit(0), "").count() == 0, name


def test_entry_registers_one_query_per_operator_and_the_pipeline():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and "op6_url_filters" in entry.oracle_sql()


def test_url_query_equals_its_sql(spark, duck):
    from sparkpanel.llm.queries import ORACLE, QUERIES

    got = QUERIES["op6_url_filters"](spark, "/root/testdata/sf0.001")
    cur = duck.execute(ORACLE["op6_url_filters"])
    names = [d[0] for d in cur.description]
    assert names == got.columns and sorted(map(str, cur.fetchall())) == sorted(str(tuple(r)) for r in got.collect())


def test_entry_works_without_the_subpackage(tmp_path):
    """A copy of the entry module beside a package without llm offers the other queries."""
    root = importlib.util.find_spec("corpus_pipeline").origin.rsplit("/", 1)[0]
    code = ("import sys\n"
            "class Hide:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith(('sparkpanel.llm', 'corpus_pipeline')):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Hide())\n"
            f"sys.path.insert(0, {root!r})\n"
            "import __spark_entry__ as e\n"
            "q = e.queries()\n"
            "assert len(q) > 150 and 'pipeline' not in q and not any(x.startswith('op1_') for x in q)\n"
            "assert set(e.oracle_sql()) <= set(q)\n")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert done.returncode == 0, done.stderr[-800:]


def test_nothing_else_in_the_library_imports_the_subpackage():
    import pathlib

    import sparkpanel

    root = pathlib.Path(sparkpanel.__file__).parent
    assert not [f for f in root.rglob("*.py") if "llm" not in f.parts and re.search(r"sparkpanel\.llm|from \.+llm", f.read_text())]


@pytest.mark.parametrize("name", ["op1_best_fit_packing", "op3_warc", "op7_kd_sharding", "op8_sentencepiece"])
def test_queries_cover_their_whole_table(spark, name):
    from sparkpanel.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    key, source = ("page_id", "pages") if name == "op3_warc" else ("doc_id", "documents")
    rows = QUERIES[name](spark, sf).collect()
    assert {r[key] for r in rows} == {r[0] for r in spark.read.parquet(f"{sf}/{source}.parquet").select(key).collect()}
    if name == "op8_sentencepiece":
        assert all(r["exact"] for r in rows)


def test_language_stage_rejects_gibberish_and_unseen_languages(spark):
    """Long texts that score 1 for some language: only the share of known words tells them apart."""
    import corpus_pipeline

    rng = random.Random(5)
    rows = [(i, t, lg, s, n) for i, t, lg, s, n in fixture_rows() if i < 60]
    clean = {r[0] for r in rows}
    noise = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(n))
    polish = "wszyscy ludzie rodz\u0105 si\u0119 wolni i r\u00f3wni pod wzgl\u0119dem swej godno\u015bci i swych praw s\u0105 oni obdarzeni rozumem i sumieniem"
    for i in range(1000, 1006):  # without a label
        rows.append((i, noise(100), None, "src0", None))
    rows += [(1006, polish, None, "src0", None), (1007, polish + " " + polish, None, "src0", None)]
    trained = [i for i in range(2000, 2020) if zlib.crc32(str(i).encode()) % 4 != 2][:3]
    rows += [(i, noise(100), "en", "src0", None) for i in trained]  # labelled and trained on
    docs = spark.createDataFrame([(i, t, lg, s, len(t)) for i, t, lg, s, _ in rows], DOCS)
    got = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, "").select("doc_id").collect()}
    assert got == clean

    one = docs.where("lang = 'en' or lang is null").where("doc_id < 2000")  # a single language: every score is 1
    got = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, one, "").select("doc_id").collect()}
    assert got == {r[0] for r in rows if r[0] < 60 and r[2] == "en"}
