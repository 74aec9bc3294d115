"""Session helpers.

Operators never change session configuration; only ``get_spark`` (used by
tests, bench and the command line) builds a session. On a cluster the caller's
session is used as-is.
"""

from __future__ import annotations

import gc
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "cohortlens", cpus: int | None = None,
              shuffle_partitions: int | None = None,
              event_log_dir: str | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cpus
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.default.parallelism", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("COHORTLENS_DRIVER_MEM", "16g"))
         .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024)))
    if event_log_dir:
        b = (b.config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", event_log_dir))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    Read from the session. Only a local session without one (tests, a laptop)
    gets a scratch folder; on a cluster a missing setting is an error, as a
    folder of the driver's machine would be invisible to the executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the cluster's checkpoint folder: cuts the
    lineage and freezes the rows (used where positions must not change on
    recomputation, and in iterative loops)."""
    folder = checkpoint_dir(df.sparkSession)
    if path := getattr(_SCRATCH, "path", None):
        path = f"{folder}/{path}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    return df.checkpoint(eager=True)


_SCRATCH = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """For work of which only numbers are kept: what this thread materializes
    inside goes to a folder of its own in the checkpoint folder, which is removed at the end."""
    before, _SCRATCH.path = getattr(_SCRATCH, "path", None), f"scratch-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/{_SCRATCH.path}")
    try:
        yield
    finally:
        _SCRATCH.path = before
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def reuse(df: DataFrame) -> DataFrame:
    """Keep an intermediate that several branches read (memory, spilling to
    disk). Lost blocks are recomputed from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def release(spark: SparkSession) -> None:
    """Drop the intermediates operators persisted (they are recomputed from
    lineage if a DataFrame that used them is evaluated again)."""
    spark.catalog.clearCache()


def let_go(spark: SparkSession) -> None:
    """Have the shuffle files of DataFrames that nobody refers to any more
    removed now: Spark does so only when the driver's garbage happens to be
    collected, which may be long after the disk is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
