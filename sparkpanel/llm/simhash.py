"""SimHash near-duplicates through deletion-variant signatures.

Fingerprints: 64-bit SimHash of word shingles.  Two fingerprints link when they differ in
at most ``2`` bits.  Cut into two 32-bit segments, one segment of a linked pair differs by
at most one bit, so the pair shares a variant of that segment with one bit position
wildcarded: 2 x 32 variants per distinct fingerprint are indexed, equal variants are
joined and every candidate is verified by its Hamming distance.

Only distinct fingerprints enter the index, so copies cost one row.  A variant bucket with
more than ``MAX_BUCKET`` fingerprints is never expanded into pairs.  Its members are linked
by an exact way that needs no pairs: two fingerprints are within two bits of each other
exactly when some 64-bit value is within one bit of both, so each member is joined to the
65 values of its radius-one ball, and equal values link (at most 65 members per value).

Links become components by alternating large-star / small-star steps on a table cut by
``checkpoint`` in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkpanel.llm.common import cut, join_weighted, materialise

MAX_BUCKET = 16
_SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text as an unsigned 64-bit number.

    ASCII letters are lower-cased, words are runs of anything but ASCII white space,
    shingles are ``shingle`` consecutive words (repeats count; a shorter text is one
    shingle; no word: 0).  A bit is set when more than half of the shingle hashes
    (XXH64, seed 42) have it.
    """
    # bytes.lower / bytes.split know ASCII only: exactly A-Z and \x20, \x09-\x0D
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, _SEED)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    hash64 = xxhash.xxh64_intdigest
    hashes = np.fromiter((hash64(joined[a:b], _SEED) for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())),
                         dtype=np.uint64, count=len(words) - shingle + 1)
    set_bits = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65_536):
        part = hashes[i:i + 65_536].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3, name: str = "fp") -> DataFrame:
    """``docs`` plus the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            prints = np.fromiter((fingerprint(t, shingle) for t in s), dtype=np.uint64, count=len(s))
            yield pd.Series(prints.view(np.int64))

    return docs.withColumn(name, run(F.col(text)))


def _variants(prints: DataFrame) -> DataFrame:
    """(key, fp): the 2 x 32 one-wildcard segment variants; segment, position and masked value in one long."""
    def of(segment: int):
        value = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)) if segment == 0 else F.shiftrightunsigned("fp", 32)
        return [F.lit((segment << 5 | p) << 32).bitwiseOR(value.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << p)))) for p in range(32)]

    return prints.select(F.explode(F.array(*of(0), *of(1))).alias("key"), "fp")


def links(prints: DataFrame, max_bits: int = 2, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(a, b): links that connect exactly the distinct fingerprints ``fp`` within ``max_bits``
    (0 to 2) of each other; ``prints`` is a written table with one row per fingerprint.

    Pairs from small buckets are verified links; members of large buckets are linked
    through shared values of their radius-one balls (see the module text), which gives the
    same components.  The ball way holds for two bits; with one bit the ball is joined with
    the fingerprints themselves, and with none distinct fingerprints have no links.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("two segments with one wildcard are used for distances of 0 to 2 bits")
    if max_bits < 2:
        near = [F.col("fp").bitwiseXOR(F.lit(_signed(1 << p))) for p in range(64 * max_bits)]
        ball = prints.select(F.col("fp").alias("a"), F.explode(F.array(*near).cast("array<bigint>")).alias("fp"))
        return ball.join(prints.select("fp"), "fp").where("a < fp").select("a", F.col("fp").alias("b"))
    # one shuffle of the variants, whatever their number: a key holds at most 1/64 of the rows,
    # because every fingerprint has 64 different keys
    sized = _variants(prints).withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("key")))
    buckets = materialise(sized.where("c > 1"), "buckets")
    member = buckets.where(F.col("c") <= max_bucket).select("key", "fp")
    other = member.withColumnRenamed("fp", "other")
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits
    pairs = member.join(other, "key").where((F.col("fp") < F.col("other")) & close) \
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))
    dense = buckets.where(F.col("c") > max_bucket).select("fp").distinct()
    if dense.isEmpty():
        return pairs.distinct()
    dense = materialise(dense, "dense")
    flips = [F.col("fp").bitwiseXOR(F.lit(_signed(1 << p))) for p in range(64)]
    ball = dense.select(F.explode(F.array(F.col("fp"), *flips)).alias("value"), "fp")
    centre = ball.groupBy("value").agg(F.count(F.lit(1)).alias("c"), F.min("fp").alias("a")).where("c > 1").drop("c")
    star = ball.join(centre, "value").where("a <> fp").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(star).distinct()


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of every component of the undirected edges (a, b).

    Alternating large-star and small-star steps; hot centres are broadcast by
    ``join_weighted``, and each round is cut in the shared folder.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        mins = e.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), F.count(F.lit(1)).alias("deg"))
        e, mins = cut(e), cut(mins)
        j = join_weighted(e, mins, "a", "deg", max(1, e.count()))
        if large:
            out = j.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(mins.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = mark(edges)
    while seen[0]:
        edges = cut(star(star(edges, True), False))
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", doc: str = "doc_id", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc, fp (signed long), component_id (smallest doc reachable
    through links, the row's own included), root (the component's smallest linked value) and
    text_hash.

    Null and empty texts have fingerprint zero and link like any other.  Null ids: a
    component with only null ids has a null component_id; otherwise nulls take the
    smallest id.  Repeated rows stay rows of their own.  Texts are read whole, whatever their
    length.  Other columns, whatever their names, are not read.  Empty table: empty result.
    """
    d = docs.select(F.col(doc), F.col(text))
    rows = materialise(with_fingerprint(d, text, shingle).select(doc, F.xxhash64(text).alias("text_hash"), "fp"), "prints")
    n_rows = rows.count()
    prints = materialise(rows.groupBy("fp").agg(F.min(doc).alias("first"), F.count(F.lit(1)).alias("n")), "distinct")
    roots = cut(components(links(prints.select("fp"), max_bits)))
    grouped = prints.join(roots, prints["fp"] == roots["node"], "left") \
        .select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    grouped = materialise(grouped, "grouped")
    # hot components: fp rows per root are pre-aggregated before the shuffle, then joined by weight
    firsts = grouped.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("w"))
    per_print = materialise(join_weighted(grouped, materialise(firsts, "firsts"), "root", "w", prints.count())
                            .select("fp", "n", "component_id", "root"), "components")
    return join_weighted(rows, per_print, "fp", "n", n_rows).select(doc, "fp", "component_id", "root", "text_hash")


def one_of_each(docs: DataFrame, text: str = "text", doc: str = "doc_id", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component (null ids last, then the
    smaller text hash); one row where id and text are repeated, the one with the smallest hash
    over all its columns.  All columns pass through, whatever their names.  Cases as in ``near_duplicates``."""
    found = near_duplicates(docs, text, doc, shingle, max_bits)
    first = found.groupBy("root").agg(F.min(F.struct(F.col(doc).isNull().alias("none"), F.col(doc).alias("id"), "text_hash")).alias("m"))
    first = first.select("m.id", "m.text_hash").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(doc).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"))
    kept = rows.join(first, rows["id"].eqNullSafe(first["id"]) & (rows["text_hash"] == first["text_hash"]), "left_semi")
    one = kept.groupBy("id", "text_hash").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select("row.*")
