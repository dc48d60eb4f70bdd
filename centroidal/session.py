"""Session defaults.

On a cluster the session comes from ``spark-submit`` and its configuration wins; these helpers only
fill in what is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every run of this library relies on; applied only where the submitted configuration
# (spark-submit, spark-defaults.conf) leaves them unset.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # files of a checkpoint go when its frame does
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "centroidal", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the library defaults.

    ``master`` and ``shuffle_partitions`` are for local runs (tests, bench); leave them ``None`` under
    ``spark-submit`` so the cluster configuration is kept.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    # Configuration already given by spark-submit / spark-defaults.conf (JVM system properties).
    submitted = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    local = bool(master and master.startswith("local"))
    if master:
        builder = builder.master(master)
        if local and not submitted.contains("spark.driver.memory"):
            # Local mode runs every task inside the driver JVM; the 1 GiB default is too small.
            builder = builder.config("spark.driver.memory", "8g")
    for key, value in DEFAULTS.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if local:
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when the session names none.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is read and used as is. Only
    a local-mode session without one (as in tests) gets a fresh local folder; on a cluster a missing
    setting is an error, because a machine-local folder is not reliable storage there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/GCS) for checkpoints")
        configured = tempfile.mkdtemp(prefix="centroidal-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory (never a machine-local one)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, through the file system that Spark writes it with."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialize(df: DataFrame, mode: str = "persist", name: str = "kept") -> DataFrame:
    """Keep a frame that several jobs read (X8); ``release`` lets it go.

    ``persist``: ``MEMORY_AND_DISK`` (spills instead of failing; a lost executor's blocks are
    recomputed from the lineage). ``checkpoint``: written as a table to the session's
    ``spark.checkpoint.dir`` and read back, for inputs whose lineage is expensive (joins). ``none``: as it is.
    """
    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "checkpoint":
        path = scratch_path(df.sparkSession, name)
        df.write.parquet(path)
        kept = df.sparkSession.read.schema(df.schema).parquet(path)
        _FOLDERS[kept] = path
        return kept
    if mode == "none":
        return df
    raise ValueError(f"unknown materialize mode {mode!r}")


def release(df: DataFrame, mode: str = "persist") -> None:
    """Undo ``materialize``: free the cached blocks, or delete the table. With ``none`` the frame is the caller's."""
    if mode == "persist":
        df.unpersist()
    elif df in _FOLDERS:
        remove(df.sparkSession, _FOLDERS.pop(df))


@contextmanager
def kept(df: DataFrame, mode: str = "persist", name: str = "kept") -> Iterator[DataFrame]:
    """``materialize`` for the time of a ``with`` block."""
    frame = materialize(df, mode, name)
    try:
        yield frame
    finally:
        release(frame, mode)
