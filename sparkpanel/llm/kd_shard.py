"""Sharding by a k-d tree over document metadata.

Native DataFrame functions only.  The table is split recursively at the weighted median
(weight: bytes) along the node's widest metadata dimension until every leaf reaches the
target bytes.  All open nodes of a level are split together, by a few aggregations over
a narrow table of the metadata; the driver sees a handful of numbers per node.

Distributed weighted median: the node's rows fall into ``BINS`` equal bins between the
node's smallest and largest coordinate; summed bytes per bin show in which bin the wanted
share is crossed; that bin becomes the next range until it holds a single value.  If a
boundary between values lies within ``TOLERANCE`` of the share, the cut is there and rows
with equal coordinates stay together; otherwise the rows of the crossing value are split
by the hash of their text (so equal texts stay together where that is possible), and a
text that is itself too heavy is split by a number that every row has of its own, so rows
that are equal in all columns can be told apart and no share of them fills a shard.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkpanel.llm.common import materialise, with_rank

BINS = 4096
TOLERANCE = 0.005
MAX_SHARDS = 100_000


def _small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Driver-made table of one row per open node (at most MAX_SHARDS), from one literal."""
    names = [c.split()[0] for c in schema.split(",")]
    literal = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(literal), f"array<struct<{schema.replace(' ', ':')}>>")))


def _crossings(part: DataFrame, open_nodes: list[dict], coordinate: Column) -> list[dict]:
    """Per open node the boundary around its wanted bytes along ``coordinate`` (a double column).

    Each node has node, lo, hi (range of coordinates still open), before (bytes of the node
    below the range) and want.  Returns per node: value (where the share is crossed), below
    (bytes strictly under it) and at (bytes on it).
    """
    spark = part.sparkSession
    done = []
    while open_nodes:
        state = F.broadcast(_small_table(spark, [(n["node"], float(n["lo"]), float(n["hi"])) for n in open_nodes],
                                         "node int,lo double,hi double"))
        inside = part.join(state, "node").withColumn("x", coordinate).where((F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))
        bins = inside.withColumn("bin", F.when(F.col("hi") > F.col("lo"), F.least(F.lit(BINS - 1), F.floor(
            (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS))).otherwise(F.lit(0)).cast("int")) \
            .groupBy("node", "bin").agg(F.sum("size").alias("w"), F.min("x").alias("x0"), F.max("x").alias("x1"))
        upto = bins.withColumn("upto", F.sum("w").over(Window.partitionBy("node").orderBy("bin")))
        want = F.broadcast(_small_table(spark, [(n["node"], int(n["want"] - n["before"])) for n in open_nodes],
                                        "node int,want bigint"))
        hit = upto.join(want, "node").where(F.col("upto") >= F.col("want")).groupBy("node").agg(
            F.min_by(F.struct("upto", "w", "x0", "x1"), "bin").alias("h")).select("node", "h.*").collect()
        by = {n["node"]: n for n in open_nodes}
        open_nodes = []
        for r in hit:
            n = by[r["node"]]
            below = n["before"] + r["upto"] - r["w"]
            if r["x0"] == r["x1"]:
                done.append({"node": r["node"], "value": r["x0"], "below": below, "at": r["w"], "want": n["want"]})
            else:
                open_nodes.append(n | {"lo": r["x0"], "hi": r["x1"], "before": below})
    return done


def _spread(df: DataFrame, dims: list[str]) -> dict[int, dict]:
    """Per node: total bytes, rows and the smallest and largest value of every dimension."""
    g = df.groupBy("node").agg(F.sum("size").alias("total"), *[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in dims])
    return {r["node"]: {"total": r["total"], **{c: (r[c]["lo"], r[c]["hi"]) for c in dims}} for r in g.collect()}


def assign(points: DataFrame, dims: list[str], n_shards: int) -> DataFrame:
    """``points`` (a written table with size, text_hash, row_hash, which differs between any two
    rows, and the double columns ``dims``) plus ``shard``, 0 to n_shards - 1, of nearly equal bytes.

    A node that stands for q shards is split so that one side holds floor(q / 2) / q of its
    bytes; dimensions are compared by their width relative to the whole table's.
    """
    if n_shards > MAX_SHARDS:
        raise ValueError(f"at most {MAX_SHARDS} shards in one call: the node table is broadcast")
    spark = points.sparkSession
    now = points.withColumn("node", F.lit(0))
    whole = _spread(now, dims).get(0)
    if whole is None:
        return points.withColumn("shard", F.lit(0))
    quota = {0: n_shards}  # node (its first shard) -> number of shards it stands for
    unit = 2.0 ** -64
    text_x = F.col("text_hash").cast("double") * unit
    row_x = F.col("row_hash").cast("double") * unit
    while any(q > 1 for q in quota.values()):
        spread = _spread(now.where(F.col("node").isin([n for n, q in quota.items() if q > 1])), dims)
        for n in [n for n, q in quota.items() if q > 1 and n not in spread]:
            quota[n] = 1  # no row fell there: fewer rows than shards, or a row as heavy as several
        tasks = []
        for node, s in spread.items():
            width = {c: (s[c][1] - s[c][0]) / ((whole[c][1] - whole[c][0]) or 1.0) for c in dims}
            dim = max(dims, key=lambda c: (width[c], -dims.index(c)))
            q = quota[node]
            tasks.append({"node": node, "dim": dim, "lo": s[dim][0], "hi": s[dim][1], "before": 0,
                          "want": max(1, s["total"] * (q // 2) // q), "total": s["total"]})
        if not tasks:
            break
        dim_of = {t["node"]: dims.index(t["dim"]) for t in tasks}
        chosen = F.broadcast(_small_table(spark, list(dim_of.items()), "node int,dim int"))
        x = F.element_at(F.array(*dims), F.col("dim") + 1)
        part = now.join(chosen, "node").withColumn("coord", x)
        slack = {t["node"]: max(1, int(t["total"] * TOLERANCE)) for t in tasks}
        cuts = {t["node"]: [math.inf, math.inf, math.inf] for t in tasks}  # last value that stays left, per key
        level, frame, left = 0, part, tasks
        for coordinate in (F.col("coord"), text_x, row_x):
            undecided = []
            for c in _crossings(frame, left, coordinate):
                node, cut = c["node"], cuts[c["node"]]
                cut[level] = c["value"]
                if abs(c["want"] - c["below"] - c["at"]) <= slack[node]:
                    pass  # the crossing value stays left as a whole
                elif abs(c["want"] - c["below"]) <= slack[node] and c["below"] > 0:
                    cut[level + 1:] = [-math.inf] * (2 - level)  # it goes right as a whole
                    if level == 2:
                        cut[2] = math.nextafter(c["value"], -math.inf)
                elif level < 2:
                    undecided.append({"node": node, "lo": -0.5, "hi": 0.5, "before": c["below"], "want": c["want"], "at": c["value"]})
            level += 1
            if not undecided or level == 3:
                break
            keep = F.broadcast(_small_table(spark, [(u["node"], float(u["at"])) for u in undecided], "node int,only double"))
            frame = frame.join(keep, "node").where(coordinate == F.col("only")).drop("only")
            left = undecided
        rows = [(n, dim_of[n], *map(float, c), n + quota[n] // 2) for n, c in cuts.items()]
        table = F.broadcast(_small_table(spark, rows, "node int,dim int,c0 double,c1 double,c2 double,right int"))
        x = F.element_at(F.array(*dims), F.col("dim") + 1)
        stays = (x < F.col("c0")) | ((x == F.col("c0")) & ((text_x < F.col("c1")) | ((text_x == F.col("c1")) & (row_x <= F.col("c2")))))
        now = now.join(table, "node", "left").withColumn(
            "node", F.when(F.col("right").isNull() | stays, F.col("node")).otherwise(F.col("right"))).drop("dim", "c0", "c1", "c2", "right")
        now = materialise(now, "level")  # the next level starts from a table, not from all joins before it
        for n in list(cuts):
            q = quota[n]
            quota[n], quota[n + q // 2] = q // 2, q - q // 2
    return now.withColumnRenamed("node", "shard")


def kd_shards(docs: DataFrame, text: str = "text", doc: str = "doc_id", categories: tuple[str, ...] = ("lang", "source"),
              target_bytes: int | None = None, n_shards: int | None = None) -> DataFrame:
    """(doc, size, text_crc32, shard, slot): every row of ``docs`` in a shard.

    Give either ``target_bytes`` (the number of shards follows) or ``n_shards``.  Dimensions:
    each category column (a hash of its value in 0 to 1; null counts as a value) and the
    logarithm of the size.  Size is the text's UTF-8 bytes plus 1 (null text: 1), whatever its
    length: a text heavier than a shard's share is in one shard all the same.  Slots number
    the rows of a shard without gaps, in no particular order.  Repeated rows count each and
    are dealt to as many shards as their bytes need; equal texts share a shard where a cut
    allows it.  Ties at a cut are decided by the text's hash, then by the row's own number.
    Other columns, whatever their names, are not read.  Empty table: empty.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    dims = [f"d{i}" for i in range(len(categories))] + ["log_size"]
    size = (F.octet_length(t) + 1).cast("long")
    unit = [(F.pmod(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit("\x00"))), F.lit(1 << 20)) / float(1 << 20)).alias(f"d{i}")
            for i, c in enumerate(categories)]
    # the table is written, so a row's own number stays what it is
    points = materialise(docs.select(F.col(doc).alias("doc"), size.alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"), *unit,
                                     F.log2(size.cast("double")).alias("log_size"), F.xxhash64(t).alias("text_hash"),
                                     F.xxhash64(F.lit("row"), F.monotonically_increasing_id()).alias("row_hash")), "points")
    whole = points.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    if n_shards is None:
        n_shards = max(1, -(-whole["bytes"] // target_bytes))
    placed = materialise(assign(points, dims, n_shards).select("doc", "size", "text_crc32", "shard", "row_hash"), "placed")
    ranked = with_rank(placed, ["shard"], "row_hash", ["doc", "row_hash"], whole["n"], "slot")
    return ranked.select(F.col("doc").alias(doc), "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
