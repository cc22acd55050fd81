"""Structured Streaming jobs.

R1  scheduled refresh of a per-item KPI table: a file stream run with
    ``trigger(availableNow=True)``; ``foreachBatch`` writes the batch's partial
    aggregates into a Parquet table partitioned by batch id (overwriting only
    that partition, so a retried batch is idempotent).  Readers aggregate the
    partials, so no read-modify-write of the table is ever needed.
R2  daily event counts with a 2-day watermark and tumbling 1-day windows.
    Spark guarantees that rows within the watermark delay are aggregated and
    bounds the state: windows older than the watermark are evicted.  Rows later
    than the watermark *may* be dropped (Spark gives no guarantee either way).
    Spikes (count > trailing mean + 3 sigma) are flagged in the batch layer.

Checkpoints and sink folders live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkpanel.functions.columns import instant_to_utc_ntz, ntz_as_utc_instant


def kpi_partials(batch: DataFrame, ts: str, key: str, value: str) -> DataFrame:
    return batch.groupBy(F.col(key), F.to_date(F.col(ts)).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("value_sum"), F.max(value).alias("value_max"))


def refresh_kpi_table(spark: SparkSession, source: str, schema, table: str, checkpoint: str,
                      ts: str = "ts", key: str = "event_type", value: str = "value") -> None:
    """Process every file that arrived since the last run, then stop (availableNow)."""
    stream = spark.readStream.schema(schema).parquet(source)

    def merge(batch: DataFrame, batch_id: int) -> None:
        part = kpi_partials(batch, ts, key, value).withColumn("batch_id", F.lit(batch_id))
        (part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(table))

    q = (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_kpi_table(spark: SparkSession, table: str, key: str = "event_type") -> DataFrame:
    """The KPI table: partial aggregates combined per (key, day)."""
    p = spark.read.parquet(table)
    return p.groupBy(key, "day").agg(F.sum("n").alias("n"), F.sum("value_sum").alias("value_sum"),
                                     F.max("value_max").alias("value_max"))


def windowed_counts(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, ts: str = "ts",
                    key: str = "event_type", watermark: str = "2 days", window: str = "1 day",
                    max_files_per_trigger: int | None = None) -> None:
    """R2: watermark + tumbling-window counts.

    Update mode: every micro-batch emits the new running count of each window it
    touched; ``foreachBatch`` stores them under the batch id (idempotent on retry).
    Append mode would hold back the windows the watermark has not closed yet, so a
    run that ends (availableNow) would never report the last days.  Windows older
    than the watermark leave the state store, which keeps state bounded.
    """
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # watermarks need TIMESTAMP: the wall time is read as UTC (exact, independent of the session zone)
    s = r.parquet(source).withColumn("__ts", ntz_as_utc_instant(ts))
    agg = (s.withWatermark("__ts", watermark).groupBy(F.window("__ts", window), F.col(key))
           .agg(F.count(F.lit(1)).alias("n")))
    out = agg.select(key, instant_to_utc_ntz(F.col("window.start")).alias("window_start"), "n")

    def store(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(sink))

    q = (out.writeStream.outputMode("update").foreachBatch(store)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_windowed_counts(spark: SparkSession, sink: str, key: str = "event_type") -> DataFrame:
    """Latest count per window: counts only grow, so the latest emitted value is the max."""
    return spark.read.parquet(sink).groupBy(key, "window_start").agg(F.max("n").alias("n"))


def spike_flags(counts: DataFrame, key: str, order: str, value: str = "n", trailing: int = 7, k: float = 3.0) -> DataFrame:
    """Batch layer of R2: count above trailing mean + k sigma of the previous ``trailing`` windows.

    The window is per key over one row per day (bounded by the calendar).
    """
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-trailing, -1)
    m, sd = F.avg(value).over(w), F.stddev_samp(value).over(w)
    return counts.select("*", m.alias("trailing_mean"), sd.alias("trailing_std"),
                         F.coalesce(F.col(value) > m + F.lit(k) * sd, F.lit(False)).alias("is_spike"))
