"""Session and scratch-location helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "mailweave",
                  shuffle_partitions: int | None = None, extra_conf: dict | None = None) -> SparkSession:
    """A session with the settings every job here relies on.

    AQE stays on (partition coalescing + skew-join splitting), the UI stays
    off, time zone is pinned to UTC so timestamp strings are reproducible and
    Arrow batches are 200 records (the reference's fetch batch size) and at
    most 64 MB, which bounds Python-side memory when a batch holds large raw
    messages.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        b = b.config(k, v)
    spark = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
        # ...and never more than 64 MB per batch, so 200 large messages with
        # attachments cannot exhaust a Python worker
        .config("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
        # a checkpoint is deleted once no plan refers to it any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # model calls are not repeatable: never run a task twice on purpose
        .config("spark.speculation", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder (``spark.checkpoint.dir``).

    Read from the session.  Only a local session without the setting gets a
    folder of its own (tests); on a cluster a folder on the driver's disk
    would be invisible to the executors, so a missing setting is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="mailweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of ``path`` in the cluster's Hadoop configuration."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared folder, with its scheme."""
    _, p = hadoop_path(spark, f"{shared_dir(spark).rstrip('/')}/mailweave/{name}-{uuid.uuid4().hex[:12]}")
    return p.toString()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)
