"""Best-fit packing of token pieces by exact-complement hashing.

A piece is at most ``capacity`` tokens, so all that decides the packing is how many pieces
of each length there are: ``capacity`` counts, whatever the size of the corpus.  The plan
is made from that histogram:

1. Exact complements: for every length, longest first, the gap it leaves is looked up in
   the index of single lengths, of sums of two and of sums of three available lengths, and
   combinations that fill the gap exactly are consumed as often as their counts allow.
2. Residuals: what is left is placed best-fit, longest first; whenever a bin opens with a
   gap, an exact complement for the gap is tried first.

The plan is a list of patterns (lengths, how often).  Pieces find their place without
gathering: each piece has a number among the pieces of its length (``with_rank``), and the
plan's slots of a length are ranges of those numbers (a broadcast table of bounded size).
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm.common import materialise, with_rank

CAPACITY = 1024
#: alphabet in which the classes of both libraries' patterns are the same beyond doubt
_PLAIN = re.compile(r"[\t-\r -~À-ɏ]*")


class TokenIds:
    """Ids of texts by the ``tokenizers`` library's file at ``path``.

    If the file is a plain byte-level BPE whose ids follow the merge order, texts of a plain
    Latin alphabet are encoded by ``tiktoken`` from the very vocabulary of the file (several
    times faster, same ids: the tests compare); all other texts, and those that hold an added
    token of the file (one id, the library's default), by ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core already
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = self._byte_level(path)

    @staticmethod
    def _byte_level(path: str):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") \
                or not pre.get("use_regex", True) or model.get("type", "BPE") != "BPE":
            return None
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes written as themselves
        other = [b for b in range(256) if b not in own]
        byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}
        special = {t["content"] for t in spec.get("added_tokens", []) if t.get("special")}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        made = [model["vocab"].get(m.replace(" ", "", 1), -1) for m in merges]
        if made != sorted(made) or len(set(made)) != len(made) or len(made) + 256 != len(ranks):
            return None
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """The ids as little-endian unsigned 32-bit numbers."""
        if self.fast is not None and _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


def tokenise(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text", doc: str = "doc_id",
             capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc, piece, start, length, ids_crc32 and, on request, ids.

    A document is its ids and ``end_id``; null text is empty.  Longer ones are cut from the
    end into full pieces of ``capacity``, so the first piece may be shorter.  Texts are read
    whole.  Other columns, whatever their names, are not read.
    """
    schema = f"{doc} {docs.schema[doc].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" \
        + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = TokenIds(tokenizer), np.array([end_id], dtype="<u4")
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                for r, t in enumerate(part.column(text).to_pylist()):
                    ids = np.concatenate([encoder.encode(t or ""), end])
                    first = len(ids) % capacity or min(len(ids), capacity)
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        row.append(r)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].tobytes()))
                        kept.append(ids[a:b].astype(np.int32) if keep_ids else None)
                arrays = [part.column(doc).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                          *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = [doc, "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    arrays.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(doc, text).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one sequence, number of such sequences) for ``counts`` of pieces per length.

    Triples fill most gaps but spend short pieces that longer ones may need later, so the
    plan is made with complements of up to three, two and one pieces; the one with the
    fewest sequences wins (ties: the one with the larger complements).
    """
    plans = [_plan(counts, capacity, most) for most in (3, 2, 1)]
    return min(plans, key=lambda p: sum(n for _, n in p))


def _plan(counts: dict[int, int], capacity: int, most_parts: int) -> list[tuple[tuple[int, ...], int]]:
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        patterns.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    sums: dict = {"two": None}

    def pair_sums() -> np.ndarray:
        """Which sums of two available lengths exist (a length counts twice if two are left)."""
        if sums["two"] is None:
            have = (left > 0).astype(np.int64)
            two = np.convolve(have, have)[:capacity + 1]
            lone = np.flatnonzero(left == 1)
            lone = lone[2 * lone <= capacity]
            two[2 * lone] -= 1
            sums["two"] = two > 0
        return sums["two"]

    def pair(gap: int, without: int = 0) -> tuple[int, int] | None:
        """The pair with the longest member that sums to ``gap``; ``without``: one piece of it is taken already."""
        if gap < 2:
            return None
        a = np.arange(gap - 1, (gap - 1) // 2, -1)
        have = left.copy()
        if without:
            have[without] -= 1
        b = gap - a
        good = np.flatnonzero((have[a] > 0) & (have[b] > 0) & ((a != b) | (have[a] > 1)))
        return (int(a[good[0]]), int(b[good[0]])) if len(good) else None

    def complement(gap: int, most: int = 3) -> tuple[int, ...] | None:
        """Available lengths that fill the gap exactly: one, two or three of them."""
        if gap <= 0:
            return None
        if left[gap] or most == 1:
            return (gap,) if left[gap] else None
        two = pair_sums()
        if gap >= 2 and two[gap] and (found := pair(gap)):
            return found
        if gap >= 3 and most >= 3:
            a = np.arange(gap - 2, 0, -1)
            for x in a[(left[a] > 0) & two[gap - a]].tolist():
                if found := pair(gap - x, x):
                    return (x, *found)
        return None

    def take(lengths: tuple[int, ...], most: int) -> int:
        """Use up the lengths together as often as they last, at most ``most`` times."""
        need = {x: lengths.count(x) for x in lengths}
        times = min(most, *(int(left[x]) // n for x, n in need.items()))
        for x, n in need.items():
            left[x] -= times * n
            if left[x] <= 1:
                sums["two"] = None
        return times

    # 1. one long piece and its exact complement
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            left[length] -= 1  # the complement must not use the piece itself
            sums["two"] = None if left[length] <= 1 else sums["two"]
            fill = complement(capacity - length, most_parts)
            left[length] += 1
            sums["two"] = None if left[length] <= 2 else sums["two"]
            if not fill or not (times := take((length, *fill), int(left[length]))):
                break
            patterns.append(((length, *fill), times))
    # 2. best fit of the rest, longest first; bins by gap
    bins: dict[int, list[list]] = {}

    def put(pattern: tuple[int, ...], gap: int, times: int) -> None:
        while times and gap and (fill := complement(gap, most_parts)):
            n = take(fill, times)
            patterns.append(((*pattern, *fill), n))
            times -= n
        if times and gap:
            bins.setdefault(gap, []).append([pattern, times])
        elif times:
            patterns.append((pattern, times))

    for length in range(capacity - 1, 0, -1):
        while left[length]:
            fitting = [g for g in bins if g >= length]
            if fitting:
                gap = min(fitting)
                group = bins[gap][-1]
                n = take((length,), group[1])
                group[1] -= n
                if not group[1]:
                    bins[gap].pop()
                    if not bins[gap]:
                        del bins[gap]
                put((*group[0], length), gap - length, n)
            else:
                n = take((length,), max(1, int(left[length]) // max(1, capacity // length)))
                put((length,), capacity - length, n)
    for groups in bins.values():
        patterns.extend((p, n) for p, n in groups)
    return patterns


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length the slots as rows (first number, first sequence, stride, offset), in number order.

    Pieces number first, first + 1, ... go to sequences first sequence, + 1, ... at ``offset``.
    """
    by: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, times in patterns:
        offset = 0
        for x in lengths:
            by.setdefault(x, []).append((used.get(x, 0), sequence, offset))
            used[x] = used.get(x, 0) + times
            offset += x
        sequence += times
    return {x: np.array(rows, dtype=np.int64) for x, rows in by.items()}


def pack(pieces: DataFrame, row: str, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table with length and ``row``, a number of its own for every row) plus
    sequence_id and offset, without ``row``.

    Pieces longer than ``capacity`` or shorter than 1 are refused.  Equal lengths are
    interchangeable; repeated rows each get a place.  Empty table: empty result.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
              .where(f"length is null or length < 1 or length > {capacity}").limit(1).collect()}
    if counts:
        raise ValueError(f"piece lengths must be 1 to {capacity}: {counts}")
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = slots(plan(counts, capacity))
    numbered = with_rank(pieces, ["length"], row, [row], sum(counts.values()), "__n")
    handle = pieces.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        lengths, numbers = length.to_numpy(), number.to_numpy()
        for x in np.unique(lengths):
            rows = np.flatnonzero(lengths == x)
            t = handle.value[int(x)]
            i = np.searchsorted(t[:, 0], numbers[rows], side="right") - 1
            sequence[rows] = t[i, 1] + numbers[rows] - t[i, 0]
            offset[rows] = t[i, 2]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return numbered.withColumn("__p", place("length", "__n")).select(
        *[c for c in pieces.columns if c != row], "__p.sequence_id", "__p.offset")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, text: str = "text", doc: str = "doc_id",
                   capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack whole documents; tokens are computed once (a written table).

    One row per piece: doc, piece, start, length, ids_crc32 (and ids), sequence_id, offset.
    Null and empty texts are one piece that holds ``end_id`` alone.  Repeated rows, null ids
    and ties are pieces like any other, each with its own place.  Very long texts are many
    pieces.  Other columns, whatever their names, are not read.  Empty table: empty result.
    """
    pieces = tokenise(docs, tokenizer, end_id, text, doc, capacity, keep_ids).withColumn("__row", F.monotonically_increasing_id())
    return pack(materialise(pieces, "pieces"), "__row", capacity)
