"""Session helpers for tests, the bench and local runs.

On a cluster the session comes from the platform; nothing here overrides
settings it already has.  ``spark.checkpoint.dir`` is read from the session
and only filled in with a scratch folder when it is unset (local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(cores: int | str = "*", shuffle_partitions: int = 8,
              app: str = "textmine", event_log_dir: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, creating a local one only if none is set.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    always used as is.  Only a local session without it (tests) gets a fresh
    scratch folder; executors elsewhere would not share one, so outside local
    mode a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all machines share, "
                               "intermediate tables go there")
        configured = tempfile.mkdtemp(prefix="textmine-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_table(spark: SparkSession, listed: bool = True) -> str:
    """A new path for an intermediate table under the checkpoint folder; it
    is the caller's until ``release`` (if ``listed``)."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    sc = spark.sparkContext
    if listed:
        sc._textmine_tables = [*getattr(sc, "_textmine_tables", []), path]
    return path


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def short_lived_shuffles(spark: SparkSession):
    """A job's shuffle files are removed when it ends, not when the driver
    next collects garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def fixed_plans(spark: SparkSession):
    """Jobs run as planned: for many small ones whose partitions are chosen,
    where planning again after every stage takes longer than the work."""
    return _setting(spark, "spark.sql.adaptive.enabled", "false")


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, its lineage cut: a compressed table under the
    checkpoint folder, which stays as long as a checkpoint would.  (A
    checkpoint keeps rows as they lie in memory: measured 5 times the bytes.)
    Its shuffles go with the job.  Rows that Parquet has no type for are
    checkpointed.  Eager."""
    spark = df.sparkSession
    names = [c.lower() for c in df.columns]
    if not names or len(set(names)) < len(names) or "void" in df.schema.simpleString():
        ensure_checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    path = scratch_table(spark, listed=False)
    with short_lived_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables of this session; returns how many.
    Results that still read them must have been written or collected."""
    paths = getattr(spark.sparkContext, "_textmine_tables", [])
    for path in paths:
        drop_table(spark, path)
    return len(paths)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete one intermediate table of this session (``scratch_table``)."""
    sc = spark.sparkContext
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    sc._textmine_tables = [p for p in getattr(sc, "_textmine_tables", []) if p != path]


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per session, so
    that Python functions run there without an installed copy.  Spark serves
    the file from the driver; nothing else on the driver's disk is read.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.abspath(__file__))
    if getattr(sc, "_textmine_shipped", False) or not os.path.isdir(root):
        return  # already sent, or itself loaded from a shipped archive
    path = os.path.join(tempfile.mkdtemp(prefix="textmine-"), "textmine_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._textmine_shipped = True
