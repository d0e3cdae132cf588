"""Exact ranking metrics from distinct-score counts (ties handled as ties, nothing down-sampled)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import ratio
from ledgerlens.operators.ordered import running_totals
from ledgerlens.session import TASK_ROWS, written


def score_counts(df: DataFrame, group: list[str], label: str = "y", score: str = "p") -> DataFrame:
    """(group, score): positives and negatives, written once. Equal scores collapse map-side."""
    counts = df.groupBy(*group, F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return written(counts, "score-counts")


def pr_curve(
    df: DataFrame, group: list[str], label: str = "y", score: str = "p", *, task_rows: int = TASK_ROWS
) -> DataFrame:
    """(group, threshold, tp, fp, precision, recall) for every distinct score, decision score >= threshold."""
    return curve_of_counts(score_counts(df, group, label, score), group, task_rows=task_rows)


def curve_of_counts(counts: DataFrame, group: list[str], *, task_rows: int = TASK_ROWS) -> DataFrame:
    upto = running_totals(
        counts, group, "threshold", ["pos", "neg"], descending=True, stored=True, task_rows=task_rows
    )
    tp, fp = F.col("pos_upto"), F.col("neg_upto")
    sums = [F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")]
    if group:
        with_totals = upto.join(counts.groupBy(*group).agg(*sums), group)
    else:
        with_totals = upto.withColumn("_all", counts.agg(F.struct(*sums)).scalar()).select("*", "_all.*")
    return with_totals.select(
        *group,
        "threshold",
        tp.alias("tp"),
        fp.alias("fp"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, F.col("positives")).alias("recall"),
        "pos",
        "neg",
        "positives",
        "negatives",
    )


def ranking_metrics(
    df: DataFrame, group: list[str], label: str = "y", score: str = "p", *, task_rows: int = TASK_ROWS
) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step sum) per group, in one pass over the curve."""
    return ranking_of_counts(score_counts(df, group, label, score), group, task_rows=task_rows)


def ranking_of_counts(counts: DataFrame, group: list[str], *, task_rows: int = TASK_ROWS) -> DataFrame:
    curve = curve_of_counts(counts, group, task_rows=task_rows)
    # Of the pairs (positive, negative): this score's negatives lose to the positives above
    # them and draw with the positives beside them.
    won = (F.col("tp") - F.col("pos") + F.col("pos") / 2.0) * F.col("neg")
    step = F.col("precision") * F.col("pos")
    pairs = F.max("positives").cast("double") * F.max("negatives")
    measures = [
        F.when(pairs > 0, F.sum(won) / pairs).alias("roc_auc"),
        F.when(F.max("positives") > 0, F.sum(step) / F.max("positives")).alias("pr_auc"),
    ]
    return curve.groupBy(*group).agg(*measures) if group else curve.agg(*measures)


def roc_auc(df: DataFrame, group: list[str], label: str = "y", score: str = "p") -> DataFrame:
    return ranking_metrics(df, group, label, score).select(*group, "roc_auc")


def pr_auc(df: DataFrame, group: list[str], label: str = "y", score: str = "p") -> DataFrame:
    return ranking_metrics(df, group, label, score).select(*group, "pr_auc")


def threshold_for_recall(
    df: DataFrame, group: list[str], target_recall: float = 0.95, label: str = "y", score: str = "p"
) -> DataFrame:
    """The threshold of highest precision with recall >= target, lowest threshold on ties.

    One row per group; a group with a single class raises.
    """
    if not 0 <= target_recall <= 1:
        raise ValueError("target_recall must be between 0 and 1.")
    curve = pr_curve(df, group, label, score)
    one_class = (F.col("positives") == 0) | (F.col("negatives") == 0)
    guard = F.when(one_class, F.raise_error(F.lit("Cannot compute a curve with only one class.")).cast("double"))
    able = curve.withColumn("recall", guard.otherwise(F.col("recall"))).where(F.col("recall") >= target_recall)
    best = F.max_by(
        F.struct("threshold", "precision", "recall"), F.struct(F.col("precision"), -F.col("threshold"))
    ).alias("best")
    found = able.groupBy(*group).agg(best) if group else able.agg(best)
    return found.select(*group, "best.threshold", "best.precision", "best.recall")
