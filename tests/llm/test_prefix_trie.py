"""The prefix trie against a brute-force version that builds every conversation."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

SCHEMA = "conv_id long, turn long, role string, text string, depth string, conv string, key string, n_convs string"


def frame(spark, rows):
    """Rows of (conv_id, turn, role, text) beside columns that carry the operator's own names."""
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[q] for q in children[p])
    return sorted((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items()) if built else []


def random_rows(seed, n):
    """Conversations that share turns, copies of whole conversations, ties in turn, nulls and one very long one."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(420), n):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(["", None, "a", "é🙂", "a" * t])))
    for c in (*range(500, 540), *range(1200, 1210)):  # copies, over several bases
        rows += [(c, t, "user", f"copy {t}") for t in range(7)]
    for c in range(700, 712):
        rows += [(c, 0, "user", "hello"), (c, 1, "user", f"own {c % 3}")]
    rows += [(903, t, "user", f"long {t % 5}") for t in range(3000)] + [(904, t, "user", f"long {t % 5}") for t in range(2900)]
    rows += [(1003, 1, "user", "same")] * 40 + [(None, 1, "user", "lost"), (1101, None, None, None)]
    rng.shuffle(rows)
    return rows


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def collected(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed,n", [(1, 120), (2, 300)])
def test_trie_matches_brute_force(spark, seed, n):
    from sparkpanel.llm.prefix_trie import prefix_trie

    rows = random_rows(seed, n)
    assert collected(prefix_trie(frame(spark, rows).repartition(5))) == brute_trie(rows)


def test_buckets_and_chunks_give_the_same_trie(spark, monkeypatch):
    """Tiny buckets of depths and chunks of ids: sums and hashes run over many of them."""
    from sparkpanel.llm import prefix_trie as t

    monkeypatch.setattr(t, "DEPTHS", 7)
    monkeypatch.setattr(t, "CHUNK_BITS", 1)
    rows = [r for r in random_rows(3, 60) if r[0] not in (903, 904)] + [(c, i, "user", f"l{i}") for c in (1400, 1401, 1402) for i in range(60)]
    assert collected(t.prefix_trie(frame(spark, rows))) == brute_trie(rows)


def test_a_collision_is_found_and_repeated_with_other_hashes(spark):
    from sparkpanel.llm import prefix_trie as t

    rows = [(c, i, "user", f"{c % 5} {i}") for c in range(100, 160) for i in range(6)]
    tiny = (3, 3, 3, 3)
    with pytest.raises(RuntimeError, match="fingerprint"):
        t.prefix_trie(frame(spark, rows), moduli=((2, 2, 2, 2), tiny))
    assert collected(t.prefix_trie(frame(spark, rows), moduli=(tiny, t.MODULI))) == brute_trie(rows)


def test_edge_tables(spark):
    from sparkpanel.llm.prefix_trie import prefix_trie

    for rows in ([], [(None, 1, "user", "lost")], [(5, None, None, None)], [(3, 1, "user", "x" * 300_000), (3, 1, "user", "x" * 300_000), (4, 1, "user", "y")]):
        assert collected(prefix_trie(frame(spark, rows))) == brute_trie(rows)


def test_registered_query_on_the_given_table(spark):
    from sparkpanel.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(QUERIES["op13_prefix_trie"](spark, folder)) == brute_trie(rows)
