"""Column expressions shared by the operators (JVM side, no Python per row)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
MISSING = "__MISSING__"
UNKNOWN = "__UNKNOWN__"
DAY_SECONDS = 86_400
HOUR_SECONDS = 3_600
STD_EPSILON = 1e-6


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def day(seconds: Column | str) -> Column:
    """Whole days since the epoch of ``seconds``, floored."""
    return F.floor(_as_column(seconds) / DAY_SECONDS).cast("bigint")


def hour(seconds: Column | str) -> Column:
    """Hour of the day, 0..23, also for negative seconds."""
    return F.pmod(F.floor(_as_column(seconds) / HOUR_SECONDS), F.lit(24)).cast("bigint")


def day_of_week(seconds: Column | str) -> Column:
    return F.pmod(F.floor(_as_column(seconds) / DAY_SECONDS), F.lit(7)).cast("bigint")


def uid(first: Column | str = "card1", second: Column | str = "addr1") -> Column:
    """Text entity key; a null part stays visible as ``nan`` so it forms a group."""
    return F.concat_ws(
        "_",
        F.coalesce(_as_column(first).cast("string"), F.lit("nan")),
        F.coalesce(_as_column(second).cast("string"), F.lit("nan")),
    )


def deviation(value: Column | str, mean: Column | str, std: Column | str) -> Column:
    return (_as_column(value) - _as_column(mean)) / (_as_column(std) + F.lit(STD_EPSILON))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom with 0.0 where the denominator is zero."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top.cast("double") / bottom.cast("double"))


def number(value: Column | str) -> Column:
    """Text or number -> double; unreadable text and NaN become null."""
    as_double = _as_column(value).try_cast("double")
    return F.when(F.isnan(as_double), None).otherwise(as_double)


def normalize_missing(df: DataFrame) -> DataFrame:
    """NaN becomes null in every float column: there is one kind of missing."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats}) if floats else df


def text(value: Column | str) -> Column:
    """Category text with the missing token."""
    return F.coalesce(_as_column(value).cast("string"), F.lit(MISSING))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def bucket_of(value: Column, cuts: Sequence[Any]) -> Column:
    """How many of the sorted ``cuts`` are <= value, as a balanced CASE tree.

    log2(len(cuts)) comparisons per row; null values land in bucket 0.
    """

    def node(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(cuts[middle]), node(middle + 1, high)).otherwise(node(low, middle))

    return node(0, len(cuts))


def bands(value: Column, uppers: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands: label i holds values <= uppers[i]; the last label the rest."""
    result = F.when(value.isNull(), None)
    for upper, label in zip(uppers, labels):
        result = result.when(value <= upper, label)
    if len(labels) > len(uppers):
        result = result.otherwise(labels[len(uppers)])
    return result


def amount_band(amount: Column | str = "TransactionAmt") -> Column:
    return bands(
        number(amount),
        [25, 50, 100, 250, 500],
        ["<=25", "25-50", "50-100", "100-250", "250-500", ">500"],
    )


def hour_band(seconds: Column | str = "TransactionDT") -> Column:
    return bands(hour(number(seconds)), [5, 11, 17, 23], ["overnight", "morning", "afternoon", "evening"])


def missing_band(count: Column | str) -> Column:
    return bands(_as_column(count), [0, 5, 20], ["0", "1-5", "6-20", "21+"])


def email_match(purchaser: Column | str = "P_emaildomain", recipient: Column | str = "R_emaildomain") -> Column:
    """1 when both domains are known and equal, 0 when known and different, null otherwise."""
    return (_as_column(purchaser) == _as_column(recipient)).cast("int")


def risk_tier(score: Column | str) -> Column:
    value = _as_column(score)
    return F.when(value >= 0.8, "high_risk").when(value >= 0.5, "medium_risk").otherwise("low_risk")
