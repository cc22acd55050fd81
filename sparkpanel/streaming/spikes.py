"""Spikes found inside the stream (R2): a stateful operator per key that keeps the trailing days.

Events are counted per key and day inside the tasks before the shuffle (a combiner over
Arrow batches), so a key that holds a third of the events sends a few rows per task.  The
state of a key is its open days and the ``trailing`` days before them: at most ``delay +
trailing + 1`` counts, whatever the events.  Every batch emits the days it changed and the
days whose trailing mean they enter; the sink keeps them per batch, so a retried batch is
idempotent, and readers take the latest row of a day.

Late events have a defined fate: an event more than ``delay`` days before the newest day that
*earlier batches* held for its key is dropped, any other is counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "key string, day date, n long, trailing_mean double, trailing_std double, is_spike boolean"
STATE = "days array<int>, counts array<long>"


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, day, n) per Arrow batch."""
    for batch in batches:
        if batch.num_rows:
            g = pa.table(batch).group_by(["key", "day"]).aggregate([([], "count_all")]).rename_columns(["key", "day", "n"])
            yield from g.combine_chunks().to_batches()


def advance(days: dict[int, int], arrived: dict[int, int], trailing: int, delay: int, k: float) -> tuple[dict[int, int], list[tuple]]:
    """One batch of one key: the next state, and rows (day, n, trailing mean, trailing deviation, spike) to emit.

    ``days``: counts by day number, kept from earlier batches; ``arrived``: the batch's counts.
    """
    newest = max(days, default=None)
    taken = {d: n for d, n in arrived.items() if newest is None or d >= newest - delay}
    if not taken:
        return days, []
    now = dict(days)
    for d, n in taken.items():
        now[d] = now.get(d, 0) + n
    order, first = sorted(now), min(taken)
    rows = []
    for i, d in enumerate(order):
        if d < first or (i > trailing and not any(x in taken for x in order[i - trailing:i + 1])):
            continue
        before = np.array([now[x] for x in order[max(0, i - trailing):i]], dtype=float)
        mean = float(before.mean()) if len(before) else None
        deviation = float(before.std(ddof=1)) if len(before) > 1 else None
        rows.append((d, now[d], mean, deviation, deviation is not None and now[d] > mean + k * deviation))
    # days that can still change, and the trailing days before the first of them
    open_from = next(i for i, d in enumerate(order) if d >= order[-1] - delay)
    return {d: now[d] for d in order[max(0, open_from - trailing):]}, rows


def spike_stream(events: DataFrame, ts: str, key: str, trailing: int = 7, delay: int = 2, k: float = 3.0, idle: str | None = None) -> DataFrame:
    """Streaming DataFrame of changed days (update mode).  Null keys and times are left out.

    ``idle`` (milliseconds): a key without events for so long loses its state.
    """
    counts = events.where(F.col(ts).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.unix_date(F.to_date(ts)).alias("day")).mapInArrow(_combine, "key string, day int, n long")

    def step(name: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        arrived: dict[int, int] = {}
        for f in frames:
            for d, n in zip(f["day"].tolist(), f["n"].tolist()):
                arrived[d] = arrived.get(d, 0) + n
        days = dict(zip(*state.get)) if state.exists else {}
        days, rows = advance(days, arrived, trailing, delay, k)
        if days:
            state.update((list(days), list(days.values())))
        if idle:
            state.setTimeoutDuration(int(idle))
        if rows:
            epoch = np.datetime64("1970-01-01", "D")
            yield pd.DataFrame([(name[0], (epoch + d).astype(object), n, m, s, bool(spike)) for d, n, m, s, spike in rows],
                               columns=["key", "day", "n", "trailing_mean", "trailing_std", "is_spike"])

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout
    return counts.groupBy("key").applyInPandasWithState(step, OUTPUT, STATE, "update", timeout)


def run_spikes(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, ts: str = "ts", key: str = "event_type",
               max_files_per_trigger: int | None = None, **options) -> None:
    """Process every file that arrived since the last run, then stop; emitted days are stored per batch."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)

    def store(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(sink))

    q = (spike_stream(r.parquet(source), ts, key, **options).writeStream.outputMode("update").foreachBatch(store)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_spikes(spark: SparkSession, sink: str) -> DataFrame:
    """The latest row of every (key, day)."""
    p = spark.read.schema(f"{OUTPUT}, batch_id long").parquet(sink)
    values = [c for c in p.columns if c not in ("key", "day", "batch_id")]
    g = p.groupBy("key", "day").agg(F.max_by(F.struct(*values), "batch_id").alias("r"))
    return g.select("key", "day", "r.*")
