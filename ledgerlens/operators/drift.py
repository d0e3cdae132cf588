"""Population stability, risk tiers and category drift against fitted state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import MISSING, bucket_of, number, risk_tier, text
from ledgerlens.operators.guards import SchemaError
from ledgerlens.operators.ordered import column_quantiles
from ledgerlens.session import TASK_ROWS

EPSILON = 1e-6
STABLE_BELOW = 0.1
WARNING_BELOW = 0.25


def _bin(value: Column, edges: list[float]) -> Column:
    """Histogram bin of a value, the last one closed; null outside the edges."""
    last = len(edges) - 2
    inside = value.isNotNull() & (value >= edges[0]) & (value <= edges[-1])
    return F.when(inside, F.least(bucket_of(value, edges) - 1, F.lit(last)))


def drift_report(
    expected: DataFrame, actual: DataFrame, columns: list[str], bins: int = 10, *, task_rows: int = TASK_ROWS
) -> DataFrame:
    """(column, psi, status) for numeric columns, all of them in one grouped job.

    Bin edges are percentiles of the expected sample (repeats allowed). Actual
    values beyond the edges fall in no bin but stay in the denominator. The
    edges, bins + 1 numbers per column, are the only thing brought to the driver.
    """
    expected, actual = (df.select(*[number(c).alias(c) for c in columns]) for df in (expected, actual))
    probabilities = [i / bins for i in range(bins + 1)]
    edges = {
        r["column"]: list(r["quantiles"])
        for r in column_quantiles(expected, columns, probabilities, task_rows=task_rows).collect()
        if r["quantiles"] is not None
    }
    absent = [c for c in columns if c not in edges]
    if absent:
        raise SchemaError(f"No values to build drift bins from: {absent}")

    def binned(df: DataFrame, side: str) -> DataFrame:
        marks = df.select(
            *[
                F.when(F.col(c).isNotNull(), F.coalesce(_bin(F.col(c).cast("double"), edges[c]), F.lit(-1))).alias(c)
                for c in columns
            ]
        )
        return (
            marks.unpivot([], columns, "column", "bin")
            .where(F.col("bin").isNotNull())
            .groupBy("column", "bin")
            .agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("side", F.lit(side))
        )

    counts = binned(expected, "expected").unionByName(binned(actual, "actual"))
    sides = ("expected", "actual")
    per_bin = counts.groupBy("column", "bin").agg(
        *[F.coalesce(F.sum(F.when(F.col("side") == s, F.col("rows"))), F.lit(0)).alias(s) for s in sides]
    )
    sizes = counts.groupBy("column").agg(
        *[F.sum(F.when(F.col("side") == s, F.col("rows"))).alias(f"n_{s}") for s in sides]
    )
    # Bins empty on both sides add nothing to the sum, so absent rows are correct.
    share = {s: F.col(s) / F.col(f"n_{s}") for s in sides}
    gap = share["actual"] - share["expected"]
    term = gap * F.log((share["actual"] + EPSILON) / (share["expected"] + EPSILON))
    psi = per_bin.where(F.col("bin") >= 0).join(sizes, "column").groupBy("column").agg(F.sum(term).alias("psi"))
    status = (
        F.when(F.col("psi") < STABLE_BELOW, "stable")
        .when(F.col("psi") < WARNING_BELOW, "warning")
        .otherwise("drift_detected")
    )
    return psi.select("column", "psi", status.alias("status"))


def psi(
    expected: DataFrame, actual: DataFrame, column: str, bins: int = 10, *, task_rows: int = TASK_ROWS
) -> DataFrame:
    return drift_report(expected, actual, [column], bins, task_rows=task_rows).select("column", "psi")


def risk_tier_counts(df: DataFrame, score: str = "score") -> DataFrame:
    """Rows per risk tier with the total beside them."""
    tiers = df.groupBy(risk_tier(score).alias("tier")).agg(F.count(F.lit(1)).alias("rows"))
    # At most three rows reach this window.
    return tiers.withColumn("total_predictions", F.sum("rows").over(Window.partitionBy()))


def unseen_category_rate(state: DataFrame, fitted_rows: int, df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: missing-rate drift, unseen rate and cardinality change against the fitted counts.

    ``state`` is (column, value, freq) over filled texts. New rows are stacked
    and counted per (column, value) first, so the join sees distinct values only.
    """
    stacked = df.select(*[text(c).alias(c) for c in columns]).unpivot([], columns, "column", "value")
    now = stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    joined = now.join(state.where(F.col("column").isin(columns)), ["column", "value"], "full_outer")
    missing = F.col("value") == MISSING
    measures = joined.groupBy("column").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("rows"))), F.lit(0)).alias("_missing"),
        F.coalesce(F.sum(F.when(missing, F.col("freq"))), F.lit(0)).alias("_fitted_missing"),
        F.coalesce(F.sum(F.when(~missing & F.col("freq").isNull(), F.col("rows"))), F.lit(0)).alias("_unseen"),
        F.count_if(~missing & F.col("rows").isNotNull()).alias("distinct_now"),
        F.count_if(~missing & F.col("freq").isNotNull()).alias("distinct_fitted"),
    )
    return measures.select(
        "column",
        (F.col("_missing") / F.col("_rows") - F.col("_fitted_missing") / F.lit(fitted_rows)).alias(
            "missing_rate_drift"
        ),
        (F.col("_unseen") / F.col("_rows")).alias("unseen_rate"),
        "distinct_fitted",
        "distinct_now",
        (F.col("distinct_now") - F.col("distinct_fitted")).alias("cardinality_change"),
    )


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop full-row duplicates, nulls equal; copies collapse before the shuffle."""
    return df.dropDuplicates()
