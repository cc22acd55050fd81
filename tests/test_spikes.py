"""Spikes inside the stream: equal to the batch layer over many batches, late rows, bounded state."""

import datetime as dt
import os
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from sparkpanel.streaming import daily, spikes

SCHEMA = StructType([StructField("ts", TimestampNTZType()), StructField("event_type", StringType())])


def test_state_is_bounded_and_rows_equal_the_whole_history():
    rng = random.Random(1)
    trailing, delay = 7, 2
    state, seen, latest = {}, Counter(), {}
    for day in range(0, 400, 3):
        newest = max(state, default=None)
        arrived = Counter(max(0, day - rng.choice([0, 0, 0, 1, 2, 3, 9])) for _ in range(rng.choice([3, 40])))
        for d, n in arrived.items():
            if newest is None or d >= newest - delay:
                seen[d] += n
        state, rows = spikes.advance(state, arrived, trailing, delay, 3.0)
        assert len(state) <= trailing + delay + 1
        latest.update({r[0]: r for r in rows})
    order = sorted(seen)
    for i, d in enumerate(order):
        before = [seen[x] for x in order[max(0, i - trailing):i]]
        _, n, mean, deviation, spike = latest[d]
        assert n == seen[d] and mean == (float(np.mean(before)) if before else None)
        assert deviation == (float(np.std(before, ddof=1)) if len(before) > 1 else None)
        assert spike == (len(before) > 1 and n > mean + 3 * deviation)
    assert sorted(latest) == order


def test_stream_over_many_files_equals_the_batch_layer(spark, tmp_path):
    rng, rows, src = random.Random(2), [], tmp_path / "src"
    src.mkdir()
    start = dt.datetime(2024, 1, 1)
    for day in range(24):
        n = 90 if day == 15 else rng.randint(5, 12)
        rows.append([(start + dt.timedelta(days=day, seconds=rng.randrange(86_400)), rng.choice(["view", "click"])) for _ in range(n)])
    rows[9] += [(start + dt.timedelta(days=7), "view")] * 3  # two days before what earlier files hold (day 8): counted
    rows[12] += [(start + dt.timedelta(days=2), "view")] * 50 + [(None, "view"), (start, None)]  # nine days late: dropped
    for i, part in enumerate(rows):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"b{i}"))
        name = next(f for f in os.listdir(tmp_path / f"b{i}") if f.endswith(".parquet"))
        os.rename(tmp_path / f"b{i}" / name, src / f"{i:03d}.parquet")
        os.utime(src / f"{i:03d}.parquet", (1_000_000 + i, 1_000_000 + i))
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    spikes.run_spikes(spark, str(src), SCHEMA, sink, ckpt, max_files_per_trigger=3)
    spikes.run_spikes(spark, str(src), SCHEMA, sink, ckpt, max_files_per_trigger=3)  # nothing new: nothing changes
    kept = [(t, k) for i, part in enumerate(rows) for t, k in part if t and k and not (i == 12 and t == start + dt.timedelta(days=2))]
    batch = spark.createDataFrame(kept, SCHEMA).groupBy(F.col("event_type").alias("key"), F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    want = daily.spike_flags(batch, "key", "day").collect()
    got = spikes.read_spikes(spark, sink).collect()
    near = lambda r: (r.key, r.day, r.n, r.trailing_mean and round(r.trailing_mean, 9), r.trailing_std and round(r.trailing_std, 9), r.is_spike)
    assert sorted(map(near, got)) == sorted(map(near, want)) and any(r.is_spike for r in got)
