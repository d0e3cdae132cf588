"""Event scoring: parse, attach fitted state, score, decide, write."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.encoding import uid_stats_apply
from ledgerlens.operators.guards import apply_threshold, check_feature_contract
from ledgerlens.sources.events import good_events, parse_event_json
from ledgerlens.streaming.sinks import batch_writer, places, run_each_batch

Scorer = Callable[[DataFrame], DataFrame]


def stream_static_enrich(stream: DataFrame, stats: DataFrame, mean: float, std: float) -> DataFrame:
    """Attach fitted entity statistics to stream rows (stream-static left join).

    ``stats`` as ``files.bucketed`` writes them are not moved: a micro-batch is shuffled to their buckets, or, where they
    are known to be small, they are broadcast.
    """
    return uid_stats_apply(stream, stats, mean, std)


def deviation_scorer(df: DataFrame) -> DataFrame:
    """A stand-in model: the logistic of the entity deviation (null deviation scores 0.5)."""
    z = F.coalesce(F.col("uid_amt_deviation"), F.lit(0.0))
    return df.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))


def stream_score(
    messages: DataFrame,
    prepare: Scorer,
    scorer: Scorer,
    threshold: float,
    path: str | None = None,
    quarantine: str | None = None,
    checkpoint: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Score JSON messages to a table; unreadable ones go to a quarantine table.

    Each batch is written under its id, so a batch replayed after a failure
    replaces itself: at-least-once input, exactly-once output. A run on a
    ``path`` of an earlier one continues it (``quarantine`` lies beside it).
    """
    spark = messages.sparkSession
    path, checkpoint = places(spark, "scored", path, checkpoint)
    quarantine = quarantine or f"{path.rstrip('/')}-quarantine"
    parsed = parse_event_json(messages.withColumn("_message", F.col("value")))

    def handle(batch: DataFrame, batch_id: int) -> None:
        good = good_events(batch).drop("_message")
        decided = apply_threshold(scorer(prepare(good)), threshold)
        batch_writer(path)(decided, batch_id)
        batch_writer(quarantine)(batch.where("_bad").select(F.col("_message").alias("value")), batch_id)

    run_each_batch(parsed, handle, checkpoint)
    return spark.read.parquet(path), spark.read.schema("value string").parquet(quarantine)


def stream_quality_counters(
    stream: DataFrame, features: list[str], path: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Contract violations per batch -> (batch_id, check, column, violations) as a table.

    ``stream`` carries ``_bad`` for unreadable input; good rows are checked
    against the feature contract, one scan per batch.
    """
    spark = stream.sparkSession
    path, checkpoint = places(spark, "quality", path, checkpoint)
    schema = "check string, column string, violations bigint"

    def handle(batch: DataFrame, batch_id: int) -> None:
        totals = batch.agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_bad")).alias("schema_failures")
        ).unpivot([], ["rows", "schema_failures"], "check", "violations")
        totals = totals.select("check", F.lit("*").alias("column"), "violations")
        broken = check_feature_contract(good_events(batch), features)
        batch_writer(path)(totals.unionByName(broken), batch_id)

    run_each_batch(stream, handle, checkpoint)
    return spark.read.schema(f"{schema}, batch_id int").parquet(path)
