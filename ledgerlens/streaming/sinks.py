"""Running streams to completion: checkpointed sinks, restarts, idempotent batch writes, late rows, closing.

An output folder and its checkpoint belong together: a later run with the same folder goes on where the last one ended,
in this process or another one. A folder that holds rows of some other run is refused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import scratch
from ledgerlens.sources.files import exists

ATTEMPTS = 3
POLL_SECONDS = 1
FAR = 221_845_392_000  # the year 9000: the time of the row that closes a stream
LATE = "batch_id bigint, late_rows bigint"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; those with a checkpoint keep the store they began with."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def places(spark: SparkSession, name: str, path: str | None, checkpoint: str | None) -> tuple[str, str]:
    """The output folder and its checkpoint, which lies inside it unless given."""
    path = path or scratch(spark, name)
    checkpoint = checkpoint or f"{path}/_checkpoint"
    if exists(spark, path) and not exists(spark, checkpoint):
        raise ValueError(f"{path} holds the output of a run whose checkpoint is not {checkpoint}")
    return path, checkpoint


def _note(query, late: dict) -> None:
    for p in query.recentProgress:
        late[p["runId"], p["batchId"], p["timestamp"]] = sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])


def _run(start: Callable, attempts: int = ATTEMPTS, report: dict | None = None) -> dict:
    """Start and await a query; a failed one restarts from its checkpoint.

    Returns the rows of each batch that came after the watermark had passed them and were dropped by the stateful
    operators. Progress is read while the query runs, as Spark keeps the last hundred records only.
    """
    late: dict = {}
    for attempt in range(1, attempts + 1):
        query = start()
        try:
            while not query.awaitTermination(POLL_SECONDS):
                _note(query, late)
            break
        except StreamingQueryException:
            if attempt == attempts:
                raise
        finally:
            _note(query, late)
    by_batch: dict = {}
    for (_, batch_id, _), n in late.items():
        by_batch[batch_id] = by_batch.get(batch_id, 0) + n
    if report is not None:
        report["late_rows"] = report.get("late_rows", 0) + sum(by_batch.values())
    return {b: n for b, n in by_batch.items() if n}


def late_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch_id, late_rows) of all runs with this checkpoint."""
    place = f"{checkpoint}/late"
    return spark.read.schema(LATE).parquet(place) if exists(spark, place) else spark.createDataFrame([], LATE)


def _drain(spark: SparkSession, start: Callable, checkpoint: str, report: dict | None, close: Callable | None) -> None:
    for step in (None, close) if close else (None,):
        if step:
            step()
        late = _run(start, report=report)
        if late:
            spark.createDataFrame(sorted(late.items()), LATE).coalesce(1).write.mode("append").parquet(f"{checkpoint}/late")


def closing(stream: DataFrame, time: str, folder: str | None = None) -> tuple[DataFrame, Callable[[], None]]:
    """``stream`` with a second source for one last row, and the function that writes it.

    For a source that has ended: the row's time lies far ahead, so all windows that are still open come out. Its own
    window never does. Rows that come after it are late.
    """
    spark = stream.sparkSession
    folder = folder or scratch(spark, "closing")
    schema = T.StructType([stream.schema[time]])
    far = F.lit(FAR).cast("timestamp") if isinstance(schema[0].dataType, T.TimestampType) else F.lit(FAR)
    if not exists(spark, folder):
        spark.createDataFrame([], schema).write.parquet(folder)
    last = spark.readStream.schema(schema).parquet(folder)

    def close() -> None:
        spark.range(1).select(far.cast(schema[0].dataType).alias(time)).coalesce(1).write.mode("append").parquet(folder)

    return stream.unionByName(last, allowMissingColumns=True), close


def run_to_parquet(
    stream: DataFrame,
    name: str,
    path: str | None = None,
    checkpoint: str | None = None,
    report: dict | None = None,
    close: Callable[[], None] | None = None,
) -> DataFrame:
    """Drain the source into an append-mode Parquet table (exactly once by the sink's log) and read it."""
    spark = stream.sparkSession
    path, checkpoint = places(spark, name, path, checkpoint)

    def start():
        writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    _drain(spark, start, checkpoint, report, close)
    return spark.read.schema(stream.schema).parquet(path)


def run_each_batch(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    report: dict | None = None,
    close: Callable[[], None] | None = None,
) -> None:
    """Drain the source through a batch function, which must tolerate seeing a batch id twice.

    The batch is kept while the function runs: its several writes would
    otherwise each read the source and the state again.
    """

    def keep_and_handle(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            handle(kept, batch_id)
        finally:
            kept.unpersist()

    def start():
        writer = stream.writeStream.foreachBatch(keep_and_handle).outputMode(mode)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    _drain(stream.sparkSession, start, checkpoint, report, close)


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Write each batch to its own folder, so a replayed batch replaces itself."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle
