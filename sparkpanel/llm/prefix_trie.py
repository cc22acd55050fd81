"""Conversation prefix trie from composable fingerprints.

The fingerprint of a sequence of turns is (length, sums): for every modulus the sum of
``hash(turn i) * BASE ** i``.  Such pairs form a monoid: ``(m, a) + (n, b) = (m + n, a + b *
BASE ** m)``.  So a rebuilt conversation, which is a head of its base conversation and its
own turns after that, is never built: each prefix of it is the product of a prefix of the
base and of a difference of two prefixes of its own turns, both taken from one table of
prefix products with a row per stored turn.

Prefix products.  Turns are range-partitioned by (conversation, place), each partition is
scanned once, and the products of partitions are joined by the same monoid: only
conversations that reach over a partition's end have to be shifted, at most one per
boundary.  A conversation of any length is many tasks.

Nodes.  Every prefix is a row (depth, fingerprint, parent's fingerprint, stored turn it ends
with).  Counting rows per node gives members; sums over a subtree are taken over the members
as well: what belongs to a node is credited to its smallest member, which also passes
through all nodes above it.

Verification.  A stored turn belongs to one node only, so equality is checked turn by turn:
all members of a node must come from the same parent and the stored turns they refer to
must hold the same role and text.  By induction over the depth the prefixes are then equal.
If a check ever fails, everything is repeated with other hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpanel.llm.common import join_weighted, materialise

#: moduli (primes below 2 ** 31, so products stay in 64 bits) and the base of the fingerprints
MODULI, BASE = (2147483647, 2147483629, 2147483587, 2147483579), 1_000_003
#: conversations whose number is a multiple of STEP lend their first turns to the next STEP - 1 ones
STEP, MAX_HEAD = 100, 5
#: turns in one partition of the scan, depths in one bucket, bits of a conversation's number inside one chunk of ends
PART_ROWS, DEPTHS, CHUNK_BITS = 200_000, 50_000, 12
ATTEMPTS = 4


def _array(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _order(turns: DataFrame) -> list[Column]:
    """Order of a conversation: turn (null first), then the first 100 characters of role and text, then their
    hashes; rows that are equal in all that are equal turns, told apart by their stored number."""
    return [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role_head"), F.col("text_head"), F.col("role_hash"), F.col("text_hash"), F.col("ref")]


def stored_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The written table of turns (ref, conv, turn, role, text, chars), ``ref`` being the number of the row."""
    return materialise(conversations.where(F.col(conv).isNotNull()).select(
        F.monotonically_increasing_id().alias("ref"), F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("chars")), "turns")


def _scan(moduli: tuple[int, ...]):
    """Local places and prefix sums of a sorted partition, batch by batch."""
    mods = np.array(moduli, dtype=np.int64)

    def powers(n: int) -> np.ndarray:
        """BASE ** 0, 1, ... (at least n of them) for every modulus, by doubling."""
        table = np.ones((1, len(mods)), dtype=np.int64)
        while len(table) < n:
            step = np.array([pow(BASE, len(table), int(m)) for m in mods], dtype=np.int64)
            table = np.concatenate([table, table * step % mods])
        return table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = powers(1024)
        current, count, carry = None, 0, np.zeros(len(mods), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_numpy()
            start = np.r_[True, conv[1:] != conv[:-1]]
            first = np.flatnonzero(start)
            segment = np.cumsum(start) - 1
            place = np.arange(len(conv)) - first[segment] + 1
            if conv[0] == current:
                place[segment == 0] += count
            else:
                carry = np.zeros(len(mods), dtype=np.int64)
            if place.max() >= len(table):
                table = powers(int(place.max()) + 1)
            hashes = np.stack([batch.column("h1").to_numpy(), batch.column("h2").to_numpy()], axis=1).view(np.uint64)
            parts = np.stack([(hashes[:, i % 2] >> np.uint64(16 * (i // 2))) % np.uint64(m) for i, m in enumerate(moduli)], axis=1).astype(np.int64)
            steps = parts * table[place] % mods
            sums = np.cumsum(steps, axis=0)
            before = np.where((first > 0)[:, None], sums[np.maximum(first - 1, 0)], -carry[None, :])
            sums = (sums - before[segment]) % mods
            current, count, carry = conv[-1], int(place[-1]), sums[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("conv"), batch.column("ref"), batch.column("chars"), pa.array(place.astype(np.int64)),
                 *(pa.array(np.ascontiguousarray(x[:, i])) for x in (sums, steps) for i in range(len(mods)))],
                ["part", "conv", "ref", "chars", "place", *(f"{c}{i}" for c in "qx" for i in range(len(mods)))])

    columns = ", ".join(f"{c}{i} long" for c in "qx" for i in range(len(mods)))
    return run, f"part int, conv long, ref long, chars long, place long, {columns}"


def prefix_products(turns: DataFrame, n_rows: int, attempt: int, moduli: tuple[int, ...]) -> DataFrame:
    """(conv, ref, chars, place, q, x) per stored turn: its place from 1 in its conversation, the sums of the prefix
    that ends with it and its own summands (arrays, one entry per modulus).  A written table."""
    spark, count = turns.sparkSession, range(len(moduli))
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "8")), -(-n_rows // PART_ROWS))
    head = lambda c: F.substr(c, F.lit(1), F.lit(100))  # noqa: E731 - bounds what the range sample holds
    keys = turns.select("ref", "conv", "turn", "chars", head("role").alias("role_head"), head("text").alias("text_head"),
                        F.xxhash64("role").alias("role_hash"), F.xxhash64("text").alias("text_hash"),
                        F.xxhash64(F.lit(2 * attempt), "role", "text").alias("h1"), F.xxhash64(F.lit(2 * attempt + 1), "role", "text").alias("h2"))
    order = _order(keys)
    ranged = keys.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    run, schema = _scan(moduli)
    local = materialise(ranged.select(F.spark_partition_id().alias("part"), "conv", "ref", "chars", "h1", "h2").mapInArrow(run, schema), "scanned")
    # products of whole partitions; a conversation in several partitions reaches over a boundary: at most one each
    ends = local.groupBy("conv", "part").agg(F.max("place").alias("n"), F.max_by(F.array(*[f"q{i}" for i in count]), "place").alias("q"))
    over = local.groupBy("conv").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select("conv")
    shifts, state = [], {}
    for r in ends.join(F.broadcast(over), "conv").orderBy("conv", "part").collect():
        n, q = state.get(r["conv"], (0, [0] * len(moduli)))
        shifts.append((r["conv"], r["part"], n, q, [pow(BASE, n, m) for m in moduli]))
        state[r["conv"]] = (n + r["n"], [(a + b * pow(BASE, n, m)) % m for a, b, m in zip(q, r["q"], moduli)])
    table = spark.createDataFrame(shifts, "conv long, part int, s_n long, s_q array<long>, s_pow array<long>")
    j = local.join(F.broadcast(table), ["conv", "part"], "left")
    shifted = F.col("s_n").isNotNull()
    q = [F.when(shifted, (F.col("s_q")[i] + F.col(f"q{i}") * F.col("s_pow")[i]) % m).otherwise(F.col(f"q{i}")) for i, m in enumerate(moduli)]
    x = [F.when(shifted, F.col(f"x{i}") * F.col("s_pow")[i] % m).otherwise(F.col(f"x{i}")) for i, m in enumerate(moduli)]
    return materialise(j.select("conv", "ref", "chars", (F.col("place") + F.coalesce("s_n", F.lit(0))).alias("place"),
                                F.array(*q).alias("q"), F.array(*x).alias("x")), "prefixes")


def _shifted(base: Column, own: Column, mark: Column, exponent: Column, moduli: tuple[int, ...]) -> Column:
    """Sums of the base's head followed by the own turns after ``mark``: base + (own - mark) * BASE ** exponent."""
    power = F.element_at(F.array(*[_array([pow(BASE, e, m) for m in moduli]) for e in range(-MAX_HEAD, 1)]), (exponent + MAX_HEAD + 1).cast("int"))
    return F.array(*[(base[i] + F.pmod(own[i] - mark[i], F.lit(m)) * power[i]) % m for i, m in enumerate(moduli)])


def _node(sums: Column) -> Column:
    """Two numbers hold the sums of four moduli (31 bits each)."""
    return F.struct((sums[0] * F.lit(1 << 31) + sums[1]).alias("a"), (sums[2] * F.lit(1 << 31) + sums[3]).alias("b"))


def rebuilt_prefixes(prefixes: DataFrame, n_rows: int, moduli: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
    """Members and conversations, both written.

    Members (conv, depth, node, parent, ref, chars): every prefix of depth 1 or more of every
    rebuilt conversation.  Conversations (conv, length, node): the whole rebuilt conversation.
    """
    zero = _array([0] * len(moduli)).cast("array<long>")
    marks = prefixes.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.when(F.col("place") <= MAX_HEAD, F.struct("place", "q", "ref", "chars")))).alias("firsts"))
    convs = materialise(marks.withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % (MAX_HEAD + 1)).cast("int")), "conversations")
    base = convs.select(F.col("conv").alias("b_conv"), F.col("n").alias("b_n"), F.col("firsts").alias("b_firsts")).where(F.col("b_conv") % STEP == 0)
    c = convs.join(base, (F.col("conv") - F.col("conv") % STEP) == F.col("b_conv"), "left")
    k = F.when(F.col("b_n").isNull(), F.lit(0)).otherwise(F.least(F.col("h"), F.col("b_n"))).cast("int")
    c = c.withColumn("k", k).select(
        "conv", "n", "h", "k", F.coalesce("b_firsts", F.array().cast(base.schema["b_firsts"].dataType)).alias("head"),
        F.when(F.col("n") >= F.col("h"), F.coalesce(F.get("firsts", F.col("h") - 1)["q"], zero)).alias("mark"))
    c = materialise(c.withColumn("head_q", F.coalesce(F.get("head", F.col("k") - 1)["q"], zero)), "heads")
    heads = c.select("conv", F.explode(F.transform(F.slice("head", 1, F.col("k")), lambda t, i: F.struct(
        (i + 1).cast("long").alias("depth"), _node(t["q"]).alias("node"),
        _node(F.coalesce(F.get("head", i - 1)["q"], zero)).alias("parent"), t["ref"].alias("ref"), t["chars"].alias("chars")))).alias("t")).select("conv", "t.*")
    # a long conversation has many turns: its one row of marks is broadcast, all others meet theirs by shuffle
    own = join_weighted(prefixes, c.where("n > h").select("conv", "n", "h", "k", "mark", "head_q"), "conv", "n", n_rows) \
        .where(F.col("place") > F.col("h"))
    gap = F.col("k") - F.col("h")
    before = F.array(*[F.pmod(F.col("q")[i] - F.col("x")[i], F.lit(m)) for i, m in enumerate(moduli)])
    tails = own.select("conv", (F.col("place") + gap).alias("depth"), _node(_shifted(F.col("head_q"), F.col("q"), F.col("mark"), gap, moduli)).alias("node"),
                       _node(_shifted(F.col("head_q"), before, F.col("mark"), gap, moduli)).alias("parent"), "ref", "chars")
    members = materialise(heads.unionByName(tails), "members")
    length = c.select("conv", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return members, materialise(length, "lengths")


def _verified(members: DataFrame, turns: DataFrame) -> bool:
    """Whether all members of every node have one parent and refer to turns with the same role and text."""
    refs = members.groupBy("depth", "node", "parent", "ref").agg(F.count(F.lit(1)).alias("c"))
    per_node = refs.groupBy("depth", "node").agg(F.count(F.lit(1)).alias("refs"), F.min("parent").alias("p0"), F.max("parent").alias("p1"))
    shared = materialise(per_node.where("refs > 1").withColumn("key", F.struct("depth", "node")), "shared")
    if not shared.where("p0 <> p1").isEmpty():
        return False
    # every stored turn belongs to one node, so this join gives at most one row per turn
    named = materialise(refs.select(F.struct("depth", "node").alias("key"), "ref"), "references")
    told = join_weighted(named, shared.select("key", "refs"), "key", "refs", named.count()).select("key", "ref")
    same = told.join(turns.select("ref", "role", "text"), "ref").groupBy("key").agg(
        *[f(c).alias(f"{c}{i}") for c in ("role", "text") for i, f in enumerate((F.min, F.max))])
    return same.where("role0 <> role1 or text0 <> text1").isEmpty()


def _ends(conversations: DataFrame) -> DataFrame:
    """(key, ends_sha256) of nodes where conversations end: SHA-256 of their ids, ascending, comma-joined.

    Ids are joined to chunks of at most 2 ** CHUNK_BITS first; a list of one chunk is hashed there.  A
    longer list runs through one hash in the order of its chunks, as SHA-256 has no parts that
    could be combined: the task that does so holds one chunk at a time.
    """
    chunks = conversations.groupBy("key", F.shiftright("conv", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    chunks = materialise(chunks, "ends")
    several = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.first("ids").alias("ids"))
    one = several.where("c = 1").select("key", F.sha2("ids", 256).alias("ends_sha256"))
    long = several.where("c > 1").select("key", "c")
    rows = join_weighted(chunks, long, "key", "c", chunks.count()).select("key", "chunk", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, digest = None, None

        def told(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], kind), pa.array([d for _, d in done], pa.string())], ["key", "ends_sha256"])

        for batch in batches:
            done = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != state:
                    if digest is not None:
                        done.append((state, digest.hexdigest()))
                    state, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield told(done)
        if digest is not None:
            yield told([(state, digest.hexdigest())])

    kind = pa.struct([("depth", pa.int64()), ("node", pa.struct([("a", pa.int64()), ("b", pa.int64())]))])
    hashed = rows.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(
        run, "key struct<depth:long,node:struct<a:long,b:long>>, ends_sha256 string")
    return one.unionByName(hashed)


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                moduli: tuple[tuple[int, ...], ...] = (MODULI,) * ATTEMPTS) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256); conversation c is the first h turns of conversation ``c - c % 100`` and its
    own turns after the first h, h being crc32 of its decimal number modulo 6.

    Turns are ordered by ``turn``, null first; rows of one conversation with the same turn
    follow each other by the first 100 characters of role and text, then by hashes of both.
    Null role or text: empty.  Rows without a conversation number belong to none and are left
    out.  Repeated rows are repeated turns.  Texts of any length are compared whole.  Other
    columns, whatever their names, are not read.  Empty table: empty result (no root).

    ``moduli``: the fingerprint of each attempt; the next one is used when two different
    prefixes met in one fingerprint, which the verification finds.
    """
    spark = conversations.sparkSession
    turns = stored_turns(conversations, conv, turn, role, text)
    n_rows = turns.count()
    for attempt, mods in enumerate(moduli):
        members, lengths = rebuilt_prefixes(prefix_products(turns, n_rows, attempt, mods), n_rows, mods)
        if _verified(members, turns):
            break
    else:
        raise RuntimeError("different prefixes met in one fingerprint at every attempt")
    return _nodes(members, lengths)


def _subtree_sums(shared: DataFrame, leaves: DataFrame) -> DataFrame:
    """(key, saved_tokens, n_leaves) from members of shared nodes (conv, depth, key, saved): per conversation the sum of
    ``saved`` over greater or equal depths and whether it stands for a leaf, added up per node.

    Depths are gapless, so buckets of DEPTHS rows are scanned apart and shifted by the totals of the later ones.
    """
    b = shared.withColumn("bucket", F.floor(F.col("depth") / DEPTHS))
    later = Window.partitionBy("conv").orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    totals = b.groupBy("conv", "bucket").agg(F.sum("saved").alias("total")).withColumn("offset", F.coalesce(F.sum("total").over(later), F.lit(0)))
    totals = totals.join(leaves, "conv", "left").select("conv", "bucket", "offset", "leaf")
    inside = Window.partitionBy("conv", "bucket").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return b.withColumn("here", F.sum("saved").over(inside)).join(totals, ["conv", "bucket"]).groupBy("key").agg(
        F.sum(F.col("here") + F.col("offset")).alias("saved_tokens"), F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"))


def _nodes(members: DataFrame, lengths: DataFrame) -> DataFrame:
    root = F.struct(F.lit(0).cast("long").alias("depth"), F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).alias("node"))
    rows = members.select("conv", "depth", F.struct("depth", "node").alias("key"), F.struct((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).alias("up"), "chars")
    roots = lengths.select("conv", F.lit(0).cast("long").alias("depth"), root.alias("key"), F.lit(None).cast(rows.schema["up"].dataType).alias("up"),
                           F.lit(0).cast("long").alias("chars"))
    rows = materialise(rows.unionByName(roots), "paths")
    n_paths = rows.count()
    nodes = rows.groupBy("key").agg(F.min("conv").alias("first"), F.count(F.lit(1)).alias("n_convs"), F.min("up").alias("up"), F.max("chars").alias("chars"))
    nodes = materialise(nodes, "nodes")
    children = nodes.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialise(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "counted")
    # what a node adds to the sums of all nodes above it goes to its smallest member, which passes through all of them
    told = join_weighted(rows, nodes.where("n_convs > 1").select("key", "n_convs", "first", "n_children", F.col("chars").alias("node_chars")),
                         "key", "n_convs", n_paths)
    mine = F.col("conv") == F.col("first")
    shared = materialise(told.select("conv", "depth", "key", F.when(mine, (F.col("n_convs") - 1) * F.col("node_chars")).otherwise(F.lit(0)).cast("long").alias("saved")), "credits")
    # a conversation's last node is a leaf if it has no children; its smallest member stands for it
    ended = lengths.join(rows.select("conv", F.col("depth").alias("length"), "key"), ["conv", "length"])
    ended = materialise(ended.select("conv", "key"), "ended")
    leaves = nodes.where("n_children = 0").select(F.col("first").alias("conv"), F.lit(1).cast("long").alias("leaf"))
    sums = _subtree_sums(shared, leaves)
    parents = nodes.select(F.col("key").alias("up"), F.col("first").alias("parent_conv_id"), "n_children").where("n_children > 0")
    below = materialise(nodes.join(sums, "key", "left").join(_ends(ended), "key", "left"), "summed")
    placed = join_weighted(below.where("up is not null").select(F.col("key").alias("own"), "up"), parents, "up", "n_children", below.count()) \
        .select("own", "parent_conv_id")
    out = below.join(placed, below["key"] == placed["own"], "left")
    return out.select(F.col("first").alias("conv_id"), F.col("key.depth").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                      F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0).cast("long")).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
