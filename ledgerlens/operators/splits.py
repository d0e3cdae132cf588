"""Time-ordered splits. Boundaries are found by counting; assigning rows is a plain projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import day
from ledgerlens.operators.guards import ID_COLUMN, TARGET_COLUMN, TIME_COLUMN, require_columns
from ledgerlens.operators.ordered import value_counts, values_at_ranks
from ledgerlens.session import TASK_ROWS, written


def sort_by_time(df: DataFrame, time: str = TIME_COLUMN, row_id: str = ID_COLUMN) -> DataFrame:
    """Total order by time, ties by id (a range-partitioned distributed sort)."""
    require_columns(df, [time], "split table")
    return df.orderBy(time, row_id)


def check_ratios(train: float, validation: float, test: float) -> None:
    if min(train, validation, test) <= 0:
        raise ValueError("Split ratios must all be positive.")
    if abs(train + validation + test - 1.0) > 1e-9:
        raise ValueError("Split ratios must sum to 1.0.")


def split_by_time_ratio(
    df: DataFrame,
    train: float = 0.70,
    validation: float = 0.15,
    test: float = 0.15,
    time: str = TIME_COLUMN,
    row_id: str = ID_COLUMN,
    target: str = TARGET_COLUMN,
    *,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``split``: earliest rows train, next validation, latest test; rows without a time come last.

    One scan counts rows per second; the two boundary rows are selected by rank
    over (time, id) and become literals, so the split itself moves no data.
    """
    require_columns(df, [time, target], "split table")
    check_ratios(train, validation, test)
    counts = written(value_counts(df, [], time), "rows-per-second")
    seconds = counts.where(F.col(time).isNotNull())
    rows = counts.agg(F.sum("rows")).first()[0] or 0
    timed = seconds.agg(F.sum("rows")).first()[0] or 0
    if rows < 3:
        raise ValueError("A time-based split needs at least 3 rows.")
    train_end = int(rows * train)
    validation_end = train_end + int(rows * validation)
    if train_end == 0 or validation_end == train_end or validation_end >= rows:
        raise ValueError("The split ratios produce an empty train, validation or test split.")
    ends = [train_end, validation_end]
    found = dict(zip(inner, values_at_ranks(seconds, time, inner, task_rows=task_rows))) if (inner := [e for e in ends if e < timed]) else {}
    in_train, in_validation = (
        _before_rank(df, end, *found[end], time, row_id, task_rows)
        if end in found
        else _before_untimed(df, end - timed, time, row_id, task_rows)
        for end in ends
    )
    return df.withColumn(
        "split", F.when(in_train, "train").when(in_validation, "validation").otherwise("test")
    )


def _before_rank(
    df: DataFrame, rank: int, moment: int, earlier: int, time: str, row_id: str, task_rows: int
) -> Column:
    """Condition that holds for the first ``rank`` rows by (time, id); ``earlier`` rows precede ``moment``."""
    if earlier == rank:
        return F.col(time) < F.lit(moment)
    tied = written(value_counts(df.where(F.col(time) == F.lit(moment)), [], row_id), "tied-rows")
    ((tied_id, _),) = values_at_ranks(tied, row_id, [rank - earlier], task_rows=task_rows)
    return (F.col(time) < F.lit(moment)) | ((F.col(time) == F.lit(moment)) & (F.col(row_id) < F.lit(tied_id)))


def _before_untimed(df: DataFrame, rank: int, time: str, row_id: str, task_rows: int) -> Column:
    """Condition that holds for all rows with a time and the first ``rank`` rows without one, by id."""
    if rank == 0:
        return F.col(time).isNotNull()
    untimed = written(value_counts(df.where(F.col(time).isNull()), [], row_id), "untimed-rows")
    ((first_out, _),) = values_at_ranks(untimed, row_id, [rank], task_rows=task_rows)
    return F.col(time).isNotNull() | (F.col(row_id) < F.lit(first_out))


def split_by_last_days(df: DataFrame, days: int = 30, time: str = TIME_COLUMN) -> DataFrame:
    """Add ``split``: the last ``days`` days are validation."""
    last = df.agg(F.max(day(time))).first()[0]
    cutoff = (last if last is not None else 0) - days
    return df.withColumn("split", F.when(day(time) <= F.lit(cutoff), "train").otherwise("validation"))


def split_summary(
    df: DataFrame, split: str = "split", time: str = TIME_COLUMN, target: str = TARGET_COLUMN
) -> DataFrame:
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(time).alias("min_time"),
        F.max(time).alias("max_time"),
        F.count_if(F.col(target) == 1).alias("fraud_rows"),
        F.lit(len([c for c in df.columns if c != split])).cast("bigint").alias("columns"),
    )
