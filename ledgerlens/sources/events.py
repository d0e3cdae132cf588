"""Transaction messages and the prediction log: JSON topics, append-only logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("TransactionID", T.LongType()),
        T.StructField("TransactionDT", T.LongType()),
        T.StructField("TransactionAmt", T.DoubleType()),
        T.StructField("ProductCD", T.StringType()),
        T.StructField("card1", T.LongType()),
        T.StructField("card2", T.LongType()),
        T.StructField("card3", T.LongType()),
        T.StructField("card4", T.StringType()),
        T.StructField("addr1", T.LongType()),
    ]
)


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON message per row in a ``value`` column (the shape a Kafka sink takes), and ``key`` as text beside it."""
    keys = [] if key is None else [F.col(key).cast("string").alias("key")]
    return df.select(*keys, F.to_json(F.struct(*df.columns)).alias("value"))


REQUIRED = ["TransactionID", "TransactionDT"]


def _typed(raw: Column, dtype: T.DataType) -> Column:
    """A message's value as the field's type; a whole number may be written as 5, 5.0 or "5"."""
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, T.IntegralType):
        as_double = raw.try_cast("double")
        whole = F.when(as_double == F.floor(as_double), as_double.try_cast(dtype))
        return F.coalesce(raw.try_cast(dtype), whole)
    return raw.try_cast(dtype)


def parse_event_json(
    messages: DataFrame,
    schema: T.StructType = TRANSACTION_SCHEMA,
    value: str = "value",
    *,
    required: Sequence[str] | None = None,
    extra: str | None = None,
) -> DataFrame:
    """JSON objects -> typed columns plus ``_bad``: true for empty or unreadable messages, or without a required field.

    A message is an open object. With ``extra``, a map column of that name holds what ``schema`` doesn't take: other
    fields, and values that can't be read as their field's type (those are null in the field). ``required`` defaults to
    the id and the time, as far as ``schema`` has them.
    """
    names = [f.name for f in schema.fields]
    required = [c for c in REQUIRED if c in names] if required is None else list(required)
    parsed = F.from_json(F.col(value).cast("string"), T.MapType(T.StringType(), T.StringType()))
    rest = [c for c in messages.columns if c != value]
    # A one-element explode keeps later filters above the parse; pushed below it they would parse again.
    rows = messages.withColumn("_parsed", F.explode(F.array(parsed)))
    fields = {f.name: _typed(F.try_element_at("_parsed", F.lit(f.name)), f.dataType) for f in schema.fields}
    bad = F.col("_parsed").isNull()
    for c in required:
        bad = bad | F.coalesce(fields[c].isNull(), F.lit(True))
    columns = [*rest, *[v.alias(c) for c, v in fields.items()], bad.alias("_bad")]
    if extra is not None:

        def left_over(k: Column, v: Column) -> Column:
            unread = F.lit(False)
            for f in schema.fields:
                unread = unread | ((k == f.name) & v.isNotNull() & _typed(v, f.dataType).isNull())
            return ~k.isin(names) | unread

        columns.append(F.map_filter("_parsed", left_over).alias(extra))
    return rows.select(*columns)


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("_bad")).drop("_bad")


def read_topic(spark: SparkSession, servers: str, topic: str, group: str | None = None) -> DataFrame:
    """Kafka topic as a stream from the earliest offset; needs the Kafka package on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def read_message_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same stream over a folder of text files, one message per line."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Publish rows as JSON messages in one batch write."""
    to_messages(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def topic_options(servers: str, topic: str, checkpoint: str, **kafka: str) -> dict[str, str]:
    """Options of a streaming Kafka sink; ``kafka`` are settings of the producer, such as ``acks``."""
    if not (servers and topic and checkpoint):
        raise ValueError("A streaming topic needs servers, a topic and a checkpoint")
    fixed = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    return {f"kafka.{name.replace('_', '.')}": value for name, value in kafka.items()} | fixed


def stream_to_topic(
    stream: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None, **kafka: str
) -> DataStreamWriter:
    """A writer that publishes stream rows as JSON messages; ``.start()`` runs it, from where its checkpoint ended.

    ``key``: the column whose text is the message key, so that an entity's messages keep their order in one partition.
    Kafka may see a batch twice after a failure: readers tell repeats by the message's id. Needs the Kafka package.
    """
    writer = to_messages(stream, key).writeStream.format("kafka").outputMode("append").queryName(f"to-{topic}")
    return writer.options(**topic_options(servers, topic, checkpoint, **kafka))


def append_prediction_log(df: DataFrame, path: str) -> None:
    """Append scored rows with a UTC write time as JSON lines."""
    stamped = df.withColumn("ts_utc", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    stamped.write.mode("append").json(path)
