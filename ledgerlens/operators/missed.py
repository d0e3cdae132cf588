"""Missed-fraud analysis: outcome flags, bands and the groups that miss most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import amount_band, hour_band, missing_band, ratio, text
from ledgerlens.session import written

# The columns rows are grouped by.
GROUP_COLUMNS = [
    "ProductCD",
    "card1",
    "card2",
    "card3",
    "card4",
    "card5",
    "card6",
    "addr1",
    "addr2",
    "P_emaildomain",
    "R_emaildomain",
    "DeviceType",
    "DeviceInfo",
    "TransactionAmt_band",
    "transaction_hour_band",
    "identity_missing_count_band",
]


def outcome_flags(df: DataFrame, threshold: float, label: str = "isFraud", score: str = "score") -> DataFrame:
    """Attach label, score, decision and the three outcome flags."""
    fraud = F.col(label) == 1
    hit = F.col(score) >= F.lit(threshold)
    return df.withColumns(
        {
            "_y_true": F.col(label).cast("int"),
            "_y_proba": F.col(score),
            "_y_pred": hit.cast("int"),
            "_is_false_negative": fraud & ~hit,
            "_is_true_positive": fraud & hit,
            "_is_non_fraud": F.col(label) == 0,
        }
    )


def add_bands(df: DataFrame) -> DataFrame:
    """Amount, hour and raw identity-missing bands, for the source columns that are there."""
    columns = {}
    if "TransactionAmt" in df.columns:
        columns["TransactionAmt_band"] = amount_band()
    if "TransactionDT" in df.columns:
        columns["transaction_hour_band"] = hour_band()
    identity = [c for c in df.columns if c.startswith("id_")]
    if identity:
        count = F.lit(0)
        for c in identity:
            count = count + F.col(c).isNull().cast("int")
        columns["identity_missing_count"] = count
        columns["identity_missing_count_band"] = missing_band(count)
    return df.withColumns(columns) if columns else df


def false_negative_rows(df: DataFrame, threshold: float, label: str = "isFraud", score: str = "score") -> DataFrame:
    """The missed and the caught fraud rows with their bands and which of the two they are."""
    flagged = add_bands(outcome_flags(df, threshold, label, score))
    kind = F.when(F.col("_is_false_negative"), "false_negative").otherwise("true_positive")
    return flagged.where(F.col("_y_true") == 1).withColumn("outcome", kind)


def top_fn_groups(flagged: DataFrame, columns: list[str] | None = None, top_n: int = 10) -> DataFrame:
    """The groups with most missed fraud over all group columns at once.

    Rows are stacked as (column, value) and counted map-side; the ranking sees
    groups only and keeps ``top_n`` per task.
    """
    present = [c for c in (columns or GROUP_COLUMNS) if c in flagged.columns]
    flags = flagged.select(
        *[text(c).alias(c) for c in present],
        F.col("_is_false_negative").cast("int").alias("_fn"),
        F.col("_is_true_positive").cast("int").alias("_tp"),
        (F.col("_y_true") == 1).cast("int").alias("_fraud"),
        (F.col("_y_true") == 0).cast("int").alias("_non_fraud"),
    )
    groups = (
        flags.unpivot(["_fn", "_tp", "_fraud", "_non_fraud"], present, "group_column", "group_value")
        .groupBy("group_column", "group_value")
        .agg(
            F.sum("_fn").alias("false_negatives"),
            F.sum("_tp").alias("true_positives"),
            F.sum("_fraud").alias("fraud_count"),
            F.sum("_non_fraud").alias("non_fraud_count"),
            F.count(F.lit(1)).alias("total_count"),
        )
        .where(F.col("false_negatives") > 0)
    )
    # Every row is in one group of each column, so one column's groups hold the total.
    groups = written(groups, "missed-groups")
    total = groups.where(F.col("group_column") == present[0]).agg(F.sum("false_negatives")).scalar()
    rated = groups.select(
        "*",
        ratio(F.col("false_negatives"), F.col("fraud_count")).alias("missed_fraud_rate"),
        ratio(F.col("false_negatives"), total).alias("false_negative_share"),
        ratio(F.col("fraud_count"), F.col("total_count")).alias("fraud_rate"),
    )
    return rated.orderBy(
        F.col("false_negatives").desc(),
        F.col("missed_fraud_rate").desc(),
        F.col("false_negative_share").desc(),
        "group_column",
        "group_value",
    ).limit(top_n)
