"""Session settings, shared folders and size limits."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows that one task may be asked to sort or hold. Anything that could grow
# past this goes through the range-split forms in operators/ordered.py.
TASK_ROWS = 1_000_000

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Wide feature projections generate methods past HotSpot's 8000-byte limit, which by
    # default are interpreted for ever (measured here: three times slower).
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    # Keeps Python call sites out of every column expression: plans build twice as fast.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "ledgerlens", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a fresh temporary
    folder of its own; a cluster without it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    return os.path.join(shared_folder(spark), "ledgerlens", spark.sparkContext.applicationId)


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder, in the part that belongs to this application."""
    return os.path.join(_own_folder(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def discard(spark: SparkSession) -> None:
    """Delete all that ``written`` and ``scratch`` made in this application; what was read from them is gone then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """For one job after another in a long session: what the job wrote to the shared folder goes when it ends."""
    try:
        yield
    finally:
        discard(spark)


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage for tables that several later jobs read, survives lost
    executors, and gives the planner true file sizes for its broadcast choice.
    """
    path = scratch(df.sparkSession, name)
    if partition_by:
        # AQE gives each folder few files and splits a folder that is too large for one task.
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
