"""Feature set v1: time, card frequencies and entity statistics, in a frozen column order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import day, hour, is_numeric
from ledgerlens.operators.encoding import amount_totals, frequency_encode, frequency_fit, uid_stats_apply, uid_stats_fit
from ledgerlens.operators.guards import (
    ID_COLUMN,
    REQUIRED_COLUMNS,
    TARGET_COLUMN,
    TIME_COLUMN,
    align_feature_schema,
    require_columns,
)
from ledgerlens.operators.lookups import looked_up
from ledgerlens.session import written

# Fixed values.
FREQUENCY_COLUMNS = ["card1", "card2", "card3", "card4"]
CONTRACT_TAIL = [
    "uid_time_to_next",
    "uid_time_from_prev",
    "uid_txn_count",
    "uid_amt_mean",
    "uid_amt_std",
    "uid_amt_median",
    "uid_amt_deviation",
]


@dataclass
class FitStateV1:
    frequencies: DataFrame
    uid_stats: DataFrame
    levels: DataFrame
    amount_mean: float
    amount_std: float
    texts: list[str]
    features: list[str]

    @property
    def contract(self) -> list[str]:
        """The longer contract: the frozen features plus the entity tail."""
        return [*self.features, *[c for c in CONTRACT_TAIL if c not in self.features]]


def fit(train: DataFrame) -> FitStateV1:
    """The schema is frozen before entity statistics exist, so they are not among ``features``."""
    require_columns(train, REQUIRED_COLUMNS, "training table")
    frequencies = written(frequency_fit(train, FREQUENCY_COLUMNS), "v1-frequencies", ["column"])
    stats = written(uid_stats_fit(train), "v1-uid-stats")
    kept = [f for f in train.schema.fields if f.name not in (ID_COLUMN, "uid", TARGET_COLUMN)]
    texts = [f.name for f in kept if not is_numeric(f.dataType)]
    stacked = train.select(*texts).unpivot([], texts, "column", "value") if texts else None
    levels = (
        written(stacked.where(F.col("value").isNotNull()).distinct(), "v1-levels", ["column"])
        if stacked is not None
        else train.sparkSession.createDataFrame([], "column string, value string")
    )
    mean, std = amount_totals(train)
    names = [f.name for f in kept]
    features = [*names, *[c for c in ("day", "hour") if c not in names], *[f"{c}_freq" for c in FREQUENCY_COLUMNS]]
    return FitStateV1(
        frequencies.select("column", "value", "freq"),
        stats,
        levels.select("column", "value"),
        mean,
        std,
        texts,
        features,
    )


def transform(df: DataFrame, state: FitStateV1, features: list[str] | None = None, key: str | None = None) -> DataFrame:
    """Rows in the frozen order; absent features are 0, texts outside the training levels null.

    Entity statistics appear only when ``features`` (e.g. ``state.contract``) asks for them.
    """
    require_columns(df, REQUIRED_COLUMNS, "table to transform")
    features = features or state.features
    timed = df.withColumns({"day": day(TIME_COLUMN), "hour": hour(TIME_COLUMN)})
    coded = frequency_encode(timed, state.frequencies, FREQUENCY_COLUMNS)
    if any(c in features for c in CONTRACT_TAIL[2:]):
        coded = uid_stats_apply(coded, state.uid_stats, state.amount_mean, state.amount_std)
    texts = [c for c in state.texts if c in coded.columns]
    if texts:
        levels = state.levels.withColumn("_level", F.col("value"))
        coded = looked_up(coded, {c: F.col(c) for c in texts}, levels, "_level", prefix="_level_")
        coded = coded.withColumns({c: F.col(f"_level_{c}") for c in texts}).drop(*[f"_level_{c}" for c in texts])
    if key is None:
        return align_feature_schema(coded, features)
    return align_feature_schema(coded, [key, *features])
