"""Composite tables: foundation, behavioral, curated, batch preparation and the flagship metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import day, hour, ratio, uid
from ledgerlens.operators.drift import dedup_rows
from ledgerlens.operators.encoding import (
    amount_totals,
    frequency_encode,
    frequency_fit,
    uid_stats_apply,
    uid_stats_fit,
    uid_window_stats,
)
from ledgerlens.operators.enrich import enrich_identity
from ledgerlens.operators.guards import apply_threshold, drop_all_null_columns
from ledgerlens.operators.policy import checked, rate_columns
from ledgerlens.operators.timeline import uid_time_gaps
from ledgerlens.session import written

CARD_COLUMNS = ["card1", "card2", "card3", "card4"]


def foundation_table(transactions: DataFrame, identity: DataFrame) -> DataFrame:
    """Join, day and hour, and each card value's count in the table itself."""
    joined = enrich_identity(transactions, identity)
    counts = written(frequency_fit(transactions, CARD_COLUMNS), "card-counts", ["column"])
    timed = joined.withColumns({"day": day("TransactionDT"), "hour": hour("TransactionDT")})
    return frequency_encode(timed, counts, CARD_COLUMNS)


def behavioral_table(transactions: DataFrame) -> DataFrame:
    """Entity key, time gaps and entity statistics of the table itself."""
    gaps = uid_time_gaps(transactions.withColumn("uid", uid()))
    return uid_window_stats(written(gaps, "gaps"))


def batch_prepare(transactions: DataFrame, identity: DataFrame) -> DataFrame:
    """Unlabelled batch: join, drop empty columns, drop duplicate rows."""
    return dedup_rows(drop_all_null_columns(enrich_identity(transactions, identity, target=None)))


def entity_risk_metrics(
    transactions: DataFrame, identity: DataFrame, threshold: float = 0.20, group: str = "ProductCD"
) -> DataFrame:
    """Scan to answer: enrich, fit and attach entity statistics, decide, and rate the decisions per group."""
    # The join keeps the rows, so what is fitted on the transactions alone is the same and cheaper.
    stats = written(uid_stats_fit(transactions), "uid-stats")
    mean, std = amount_totals(transactions)
    enriched = uid_stats_apply(enrich_identity(transactions, identity), stats, mean, std)
    decided = apply_threshold(checked(enriched, "isFraud", "score"), threshold)
    hit, fraud = F.col("fraud_prediction") == 1, F.col("isFraud") == 1
    rated = decided.groupBy(group).agg(
        F.count_if(~hit & ~fraud).alias("tn"),
        F.count_if(hit & ~fraud).alias("fp"),
        F.count_if(~hit & fraud).alias("fn"),
        F.count_if(hit & fraud).alias("tp"),
        F.avg("uid_amt_deviation").alias("mean_deviation"),
        F.sum("uid_txn_count").alias("entity_rows"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    accuracy = ratio(tp + tn, tp + tn + fp + fn)
    return rated.withColumns(
        {"accuracy": accuracy, **rate_columns(tp, fp, fn, tn), "threshold": F.lit(float(threshold))}
    )
