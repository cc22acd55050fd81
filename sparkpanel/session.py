"""Session construction and the few session-level settings the library relies on.

The library never creates a cluster session on its own in production code: jobs
receive the caller's ``SparkSession``.  ``get_session`` is for tests, the bench and
local runs; it keeps ANSI mode on (the null/raise ledger in the docs assumes it),
turns AQE on and keeps the web UI off.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet input splits: 128 MB keeps task input well inside executor memory.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # distributed ranks checkpoint their range-partitioned input; remove those files
    # once the DataFrame is garbage-collected instead of keeping them forever
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sparkpanel", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    master = master or os.environ.get("SPARKPANEL_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf.setdefault("spark.driver.memory", "16g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The setting is read from the session and used as is.  Only a plain ``local``
    master (tests: driver and tasks are one process) may go without it and gets a
    scratch folder; on any other master a missing setting is an error, because a
    folder on the driver's disk would not be visible to the executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context; the server's setting applies
        sc = None
    path = spark.conf.get("spark.checkpoint.dir", None) or (sc.getConf().get("spark.checkpoint.dir", None) if sc else None)
    if not path:
        if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the driver and all executors")
        path = tempfile.mkdtemp(prefix="sparkpanel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and not sc._jsc.getCheckpointDir().isPresent():
        sc.setCheckpointDir(path)
    return path


def _session_folder(spark: SparkSession, base: str) -> str:
    """One folder per application for written intermediate tables.

    Hadoop removes it when the driver's JVM ends (``deleteOnExit``), so a finished job
    leaves nothing behind in the shared folder.
    """
    sc = spark.sparkContext
    folder = f"{base}/sparkpanel-{sc.applicationId}"
    jpath = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        fs.mkdirs(jpath)
        fs.deleteOnExit(jpath)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written intermediate table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{_session_folder(spark, base)}/{name}-{uuid.uuid4().hex[:12]}"
