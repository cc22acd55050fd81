"""Streaming queries: each runs a Structured Streaming job over the
supplied events table and returns the sink as a DataFrame (stream = batch is the oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.functions import columns as C
from sparkpanel.plans.registry import query
from sparkpanel.session import scratch_path
from sparkpanel.sources.tables import Tables
from sparkpanel.streaming import daily, spikes

R = 4


def _events_source(spark, sf) -> tuple[str, object]:
    """The given events table as the stream's own source: nothing is copied.

    A file source takes a folder or a pattern, so the table's name is given as a pattern.
    """
    return f"{sf.rstrip('/')}/event[s].parquet", Tables(spark, sf).events.schema


@query("stream_kpi_refresh", f"""
select event_type, cast(ts as date) as day, count(*) as n, round(sum(value), {R}) as value_sum, max(value) as value_max
from events group by 1, 2""")
def stream_kpi_refresh(spark, sf):
    """availableNow file stream + foreachBatch partial aggregates -> KPI table."""
    src, schema = _events_source(spark, sf)
    table, ckpt = scratch_path(spark, "kpi-table"), scratch_path(spark, "kpi-ckpt")
    daily.refresh_kpi_table(spark, src, schema, table, ckpt)
    k = daily.read_kpi_table(spark, table)
    return k.select("event_type", "day", "n", C.round_half_away("value_sum", R).alias("value_sum"), "value_max")


@query("stream_daily_counts", """
select event_type, date_trunc('day', ts) as window_start, count(*) as n from events group by 1, 2""")
def stream_daily_counts(spark, sf):
    """R2: 2-day watermark, tumbling 1-day windows (update mode + foreachBatch); equals the batch counts."""
    src, schema = _events_source(spark, sf)
    sink, ckpt = scratch_path(spark, "daily-sink"), scratch_path(spark, "daily-ckpt")
    daily.windowed_counts(spark, src, schema, sink, ckpt)
    return daily.read_windowed_counts(spark, sink).select("event_type", "window_start", "n")


@query("spike_alerts", f"""
with d as (select event_type, cast(ts as date) as day, count(*) as n from events group by 1, 2),
w as (select *, avg(n) over t as m, stddev_samp(n) over t as sd from d
      window t as (partition by event_type order by day rows between 7 preceding and 1 preceding))
select event_type, day, n, round(m, {R}) as trailing_mean, round(sd, {R}) as trailing_std,
       coalesce(n > m + 3 * sd, false) as is_spike from w""")
def spike_alerts(spark, sf):
    """R2 batch layer: daily count above the trailing 7-day mean + 3 sigma."""
    e = Tables(spark, sf).events
    d = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    s = daily.spike_flags(d, "event_type", "day")
    return s.select("event_type", "day", "n", C.round_half_away("trailing_mean", R).alias("trailing_mean"),
                    C.round_half_away("trailing_std", R).alias("trailing_std"), "is_spike")


@query("stream_spikes", f"""
with d as (select event_type, cast(ts as date) as day, count(*) as n from events group by 1, 2),
w as (select *, avg(n) over t as m, stddev_samp(n) over t as sd from d
      window t as (partition by event_type order by day rows between 7 preceding and 1 preceding))
select event_type, day, n, round(m, {R}) as trailing_mean, round(sd, {R}) as trailing_std,
       coalesce(n > m + 3 * sd, false) as is_spike from w""")
def stream_spikes(spark, sf):
    """R2: spikes flagged inside the stream by a stateful operator per event type; equals the batch layer."""
    src, schema = _events_source(spark, sf)
    sink = scratch_path(spark, "spike-sink")
    spikes.run_spikes(spark, src, schema, sink, scratch_path(spark, "spike-ckpt"))
    return spikes.read_spikes(spark, sink).select(
        F.col("key").alias("event_type"), "day", "n", C.round_half_away("trailing_mean", R).alias("trailing_mean"),
        C.round_half_away("trailing_std", R).alias("trailing_std"), "is_spike")
