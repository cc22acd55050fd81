"""Approximate nearest neighbours with randomly rotated one-bit codes.

Every distinct vector is centred, rotated by a seeded random orthogonal matrix and stored as
the signs of its coordinates (packed bits) with two correction scalars: its distance to the
centre and the inner product of its direction with its code.  For a query the packed bits
give an unbiased estimate of the inner product with every vector; the scalars give the
width of its error, so each candidate has a lower and an upper bound of its distance.
Candidates whose lower bound does not exceed the k-th smallest upper bound are reranked
by the exact distance on the original vectors in double precision.

All vectors are indexed, and the index never moves: the queries come to it in blocks of
``QUERIES`` vectors (a broadcast of bounded size), each task walks its part of the written
index and keeps the k + 1 best entries per query, and only those are shuffled.  The lower
bounds of ``ROWS`` codes for all queries of a block are one matrix product: the signs are
unpacked once per batch, the scalars and their error terms ride along as extra columns.
Original vectors are touched only where a lower bound does not exceed the query's threshold,
which falls as better entries are found.

Equal vectors are one entry with its k + 1 smallest ids (no more can be among the k
nearest), so a vector that a third of the rows share costs one row.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - makes pa.compute available
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkpanel.llm.common import materialise

#: queries in one block; codes in one matrix product; pairs reranked at once
QUERIES, ROWS, PAIRS = 8192, 1024, 50_000
#: width of the error bound in standard deviations of the estimate
EPSILON = 4.0
SEED = 7


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix (QR of a Gaussian one), the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v, dim): rows with an id whose vector is not null, not zero and all finite."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(key).alias("id"), v.alias("v")).where("id is not null and v is not null and size(v) > 0")
    return rows.where(finite & F.exists(F.col("v"), lambda x: x != 0)).withColumn("dim", F.size("v"))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(entry, dim, v, ids): every distinct vector once, with its k + 1 smallest ids.

    Two rounds: the smallest ids inside salted parts of a vector's rows first, so no task
    gathers all copies of a vector.
    """
    keyed = rows.select("dim", "v", "id").withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))) \
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64))).dropDuplicates(["v", "id"])
    part = Window.partitionBy("v", "salt").orderBy("id")
    few = keyed.withColumn("r", F.row_number().over(part)).where(F.col("r") <= k + 1)
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    ids = few.groupBy("v").agg(F.first("dim").alias("dim"), F.array_sort(F.collect_list("id")).alias("ids"))
    return ids.select(F.monotonically_increasing_id().alias("entry"), "dim", "v", "ids")


def _sums(batches):
    """Per dimension the coordinate sums and the number of vectors of a task."""
    found: dict[int, list] = {}
    for pdf in batches:
        for dim, part in pdf.groupby("dim"):
            m = np.array(part["v"].tolist())
            have = found.setdefault(int(dim), [np.zeros(int(dim)), 0])
            have[0] += m.sum(axis=0)
            have[1] += len(m)
    yield pd.DataFrame([(d, s.tolist(), n) for d, (s, n) in found.items()], columns=["dim", "s", "n"])


def centres(entries: DataFrame) -> dict[int, np.ndarray]:
    """Mean vector per dimension: one partial sum per task and dimension."""
    parts = entries.select("dim", "v").mapInPandas(_sums, "dim int, s array<double>, n long") \
        .select("dim", "n", F.posexplode("s").alias("i", "x")).groupBy("dim", "i").agg((F.sum("x") / F.sum("n")).alias("c"))
    out: dict[int, list] = {}
    for r in parts.orderBy("dim", "i").collect():
        out.setdefault(r["dim"], []).append(r["c"])
    return {d: np.array(c) for d, c in out.items()}


def codes_of(matrix: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed sign bits, distance to the centre, inner product of direction and code) of every row."""
    moved = (matrix - centre) @ turn
    norm = np.linalg.norm(moved, axis=1)
    unit = moved / np.where(norm > 0, norm, 1.0)[:, None]
    return np.packbits(moved > 0, axis=1), norm, np.abs(unit).sum(axis=1) / np.sqrt(matrix.shape[1])


def index(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10):
    """The written index (dim, v, ids, code, norm, dot) of all usable rows, and the centres per dimension."""
    entries = materialise(distinct_vectors(usable(vectors, key, vector), k), "entries")
    middle = entries.sparkSession.sparkContext.broadcast(centres(entries))

    def encode(batches):
        for pdf in batches:
            out = []
            for dim, part in pdf.groupby("dim"):
                bits, norm, dot = codes_of(np.array(part["v"].tolist()), middle.value[int(dim)], rotation(int(dim)))
                out.append(part.assign(code=[b.tobytes() for b in bits], norm=norm, dot=dot))
            if out:
                yield pd.concat(out)

    coded = entries.drop("entry").mapInPandas(encode, "dim int, v array<double>, ids array<long>, code binary, norm double, dot double")
    return materialise(coded, "index"), middle


class Nearest:
    """The ``most`` best entries of every query of a block, by (distance, smallest id)."""

    def __init__(self, wanted: np.ndarray, centre: np.ndarray, most: int):
        self.wanted, self.most, self.dim = wanted, most, len(centre)
        self.centre = centre
        moved = (wanted - centre) @ rotation(self.dim)
        length = np.linalg.norm(moved, axis=1)
        one = np.ones(len(wanted))
        # one column per query: the lower bound of the squared distance is the product of a code's row with it
        self.right = np.stack([*(-moved.T / np.sqrt(self.dim)), -length, one, (1 - 1e-4) * length ** 2]).astype(np.float32)
        self.limit = np.full(len(wanted), np.inf)
        self.query, self.score, self.first = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.ids: pa.Array | None = None

    def _left(self, code: pa.Array, norm: np.ndarray, dot: np.ndarray) -> np.ndarray:
        """Rows (scaled signs, error term, squared norm, 1) of a batch of codes."""
        width = -(-self.dim // 8)
        bits = np.frombuffer(b"".join(code.to_pylist()), np.uint8).reshape(-1, width)
        signs = np.unpackbits(bits, axis=1, count=self.dim).astype(np.float32) * 2 - 1
        safe = np.where(dot > 0, dot, 1.0)
        # <direction, query> is estimated by <code, query> / dot; the error shrinks with dot and dimension
        error = EPSILON * np.sqrt(np.maximum(0.0, 1 - dot ** 2)) / safe / np.sqrt(max(1, self.dim - 1))
        extra = np.stack([2 * norm * error, (1 - 1e-4) * norm ** 2, np.ones(len(norm))], axis=1)
        return np.hstack([signs * (2 * norm / safe)[:, None], extra]).astype(np.float32)

    def _start(self, data: np.ndarray) -> None:
        """Thresholds from the first vectors: the k-th smallest distance to them, widened by the product's rounding."""
        size = (data ** 2).sum(axis=1)[:, None] + (self.wanted ** 2).sum(axis=1)[None, :]
        squared = size - 2 * data @ self.wanted.T
        self.limit = np.partition(squared + 1e-9 * size, self.most - 1, axis=0)[self.most - 1]

    def see(self, batch: pa.RecordBatch) -> None:
        """Take in a batch of the index (v, ids, code, norm, dot)."""
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            data = part.column("v").flatten().to_numpy().reshape(part.num_rows, self.dim)
            if self.ids is None and len(data) >= self.most:
                self._start(data)
            left = self._left(part.column("code"), part.column("norm").to_numpy(), part.column("dot").to_numpy())
            row, query = np.nonzero(left @ self.right <= self.limit.astype(np.float32) * np.float32(1 + 1e-5))
            first = part.column("ids").flatten().to_numpy()[np.r_[0, np.cumsum(pa.compute.list_value_length(part.column("ids")).to_numpy())[:-1]]]
            found = []
            for i in range(0, len(row), PAIRS):
                r, q = row[i:i + PAIRS], query[i:i + PAIRS]
                exact = np.sqrt(((data[r] - self.wanted[q]) ** 2).sum(axis=1))
                keep = exact ** 2 <= self.limit[q] * (1 + 1e-12)
                found.append((r[keep], q[keep], exact[keep]))
            if found:
                r, q, score = (np.concatenate(x) for x in zip(*found))
                self._merge(q, score, first[r], part.column("ids").take(pa.array(r, pa.int64())))

    def _merge(self, query: np.ndarray, score: np.ndarray, first: np.ndarray, ids: pa.Array) -> None:
        query, score, first = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.first, first)))
        ids = ids if self.ids is None else pa.concat_arrays([self.ids, ids])
        order = np.lexsort((first, score, query))
        starts = np.searchsorted(query[order], query[order])
        rank = np.arange(len(order)) - starts
        keep = order[rank < self.most]
        last = order[rank == self.most - 1]
        self.limit[query[last]] = np.minimum(self.limit[query[last]], score[last] ** 2)
        self.query, self.score, self.first = query[keep], score[keep], first[keep]
        self.ids = ids.take(pa.array(keep, pa.int64()))


def scan_block(coded: DataFrame, numbers: np.ndarray, wanted: np.ndarray, centre: np.ndarray, most: int) -> DataFrame:
    """(query, score, ids): per task of ``coded`` (one dimension of the index) the ``most`` best entries of every query."""
    handle = coded.sparkSession.sparkContext.broadcast((numbers, wanted, centre))

    def run(batches):
        names, vectors, middle = handle.value
        nearest = Nearest(vectors, middle, most)
        for batch in batches:
            nearest.see(batch)
        if nearest.ids is not None:
            yield pa.RecordBatch.from_arrays([pa.array(names[nearest.query], pa.int64()), pa.array(nearest.score),
                                              nearest.ids.cast(pa.list_(pa.int64()))], ["query", "score", "ids"])

    return coded.select("v", "ids", "code", "norm", "dot").mapInArrow(run, "query long, score double, ids array<long>")


def search(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 10) -> DataFrame:
    """(query_id, rank, id, score): the k nearest of all other usable rows for every query row.

    ``is_query`` is a condition on the id, as a function of the id column.  Nearest first by
    Euclidean distance in double precision, ties to the smaller id.  Vectors of another
    dimension are no candidates.  Null, zero and non-finite vectors take no part.  Repeated
    rows (equal id and vector) count once; an id with several vectors is several candidates,
    and none of them is its own.  Fewer than k candidates: all.  Other columns, whatever their
    names, are not read.  Empty table: empty result.
    """
    spark = vectors.sparkSession
    coded, middle = index(vectors, key, vector, k)
    queries = materialise(usable(vectors, key, vector).where(is_query(F.col("id"))).select("dim", F.col("v"), "id").distinct(), "queries")
    # one search per distinct query vector, for k + 1 entries: a query's own row may be one of them
    asked = queries.select("dim", F.transform("v", lambda x: x + F.lit(0.0)).alias("v")).distinct() \
        .withColumn("query", F.monotonically_increasing_id())
    asked = materialise(asked, "asked")
    found = []
    for r in asked.groupBy("dim").count().collect():
        dim, n_parts = r["dim"], -(-r["count"] // QUERIES)
        mine = asked.where(F.col("dim") == dim).withColumn("part", F.pmod(F.xxhash64("query"), F.lit(n_parts)))
        for part in range(n_parts):
            block = mine.where(F.col("part") == part).select("query", "v").toPandas()  # about QUERIES rows
            if len(block):
                one = scan_block(coded.where(F.col("dim") == dim), block["query"].to_numpy(), np.array(block["v"].tolist()), middle.value[dim], k + 1)
                found.append(materialise(one, "found"))
    if not found:
        kind = vectors.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"query_id {kind}, rank int, `{key}` {kind}, score double")
    # per distinct query vector: the best k + 1 ids of all tasks (each task sent its own best)
    ids = reduce(DataFrame.unionByName, found).select("query", "score", F.explode("ids").alias("vec"))
    best = ids.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec"))).where(F.col("r") <= k + 1)
    listed = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("score", "vec"))).alias("best")).join(asked, "query")
    mine = queries.select("dim", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"), "id").distinct()
    # a query vector may be shared by many queries: its one row of answers is dealt out by salts
    salts = 16
    wide = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    j = mine.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")).join(wide, ["dim", "v", "salt"])
    others = F.slice(F.filter("best", lambda b: b["vec"] != F.col("id")), 1, k)
    return j.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "b")) \
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec").alias(key), F.col("b.score").alias("score"))
