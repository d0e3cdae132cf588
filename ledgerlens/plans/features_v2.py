"""Feature set v2: state fitted on training rows only, applied to any split.

Fitting reads the training table for medians and once more for all category
counts; applying is one projection plus one lookup per category column.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import MISSING, UNKNOWN, day, hour, is_numeric
from ledgerlens.operators.encoding import (
    FLAGGED_COLUMNS,
    categorical_fill,
    identity_missingness,
    interaction_columns,
    missing_flags,
    numeric_coerce_impute,
    numeric_median_fit,
)
from ledgerlens.operators.guards import (
    ID_CATEGORY_LIMIT,
    ID_COLUMN,
    REQUIRED_COLUMNS,
    TARGET_COLUMN,
    TIME_COLUMN,
    align_feature_schema,
    require_columns,
)
from ledgerlens.operators.lookups import looked_up, quoted
from ledgerlens.session import TASK_ROWS, written
from ledgerlens.sources.files import exists

# The columns whose training counts become features, and the unseen count.
FREQUENCY_COLUMNS = [
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
    "ProductCD",
]
FREQUENCY_UNSEEN = 0
INLINE_VALUES = 1_000  # values of one column that may stand in a plan as a set
INLINE_COUNTS = 64  # values of one column that may stand in a plan as a map, most frequent first
INTERACTION_TEXTS = [
    "ProductCD_DeviceType_missing_interaction",
    "ProductCD_DeviceInfo_missing_interaction",
    "ProductCD_R_emaildomain_missing_interaction",
    "card3_addr2_interaction",
    "card4_card6_interaction",
]
VERSION = "v2"


@dataclass
class FitState:
    """What training leaves behind: short lists, one median per column, and a counts table."""

    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float]
    counts: DataFrame  # (column, value, freq), filled texts seen in training
    sizes: dict[str, int]  # distinct values per column of ``counts``
    features: list[str]
    rows: int
    version: str = VERSION
    extra: dict = field(default_factory=dict)
    _listed: dict[str, dict[str, int]] | None = None

    def small_values(self) -> dict[str, dict[str, int]]:
        """Values and counts of the columns with at most INLINE_VALUES values, read once."""
        if self._listed is None:
            small = [c for c, n in self.sizes.items() if n <= INLINE_VALUES]
            self._listed = {c: {} for c in small}
            for row in self.counts.where(F.col("column").isin(small)).collect():
                self._listed[row["column"]][row["value"]] = row["freq"]
        return self._listed


def input_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (ID_COLUMN, TARGET_COLUMN, "uid_time_to_next")]


def may_be_category(df: DataFrame) -> list[str]:
    """Cards, addresses, ids and everything that is not a number."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in input_columns(df) if c.startswith(("card", "addr", "id_")) or not is_numeric(types[c])]


def prepare(df: DataFrame, numeric: dict[str, float], categorical: list[str]) -> DataFrame:
    """Impute numbers and fill texts, before any vocabulary."""
    return categorical_fill(numeric_coerce_impute(df, numeric), categorical)


def derive(df: DataFrame, present: list[str]) -> DataFrame:
    """Time, missingness and interaction columns from prepared columns.

    ``present`` are the input columns the raw table had: a category column that
    was absent counts as missing for its flag.
    """
    absent = [c for c in FLAGGED_COLUMNS if c in df.columns and c not in present]
    base = df.withColumns({c: F.lit(MISSING) for c in absent}) if absent else df
    timed = base.withColumns({"transaction_hour": hour(TIME_COLUMN), "transaction_day": day(TIME_COLUMN)})
    ids = [c for c in present if c.startswith("id_")]
    flagged = identity_missingness(missing_flags(timed), ids)
    return flagged.withColumns(interaction_columns(flagged))


def derived_names(numeric: list[str]) -> list[str]:
    return [
        *[f"{c}_was_missing" for c in numeric],
        "transaction_hour",
        "transaction_day",
        *[f"{c}_missing_flag" for c in FLAGGED_COLUMNS],
        "identity_missing_count",
        "identity_missing_ratio",
        "high_identity_missing_flag",
        "ProductCD_W_flag",
        *INTERACTION_TEXTS,
    ]


def fit(train: DataFrame, *, task_rows: int = TASK_ROWS) -> FitState:
    """Learn column types, category counts and medians from training rows.

    One stacked count covers every possible category column and the
    interactions; an ``id_*`` column that turns out to have too many values is
    numeric after all. Medians of the numeric columns are a second read.
    """
    require_columns(train, REQUIRED_COLUMNS, "training table")
    columns = input_columns(train)
    candidates = may_be_category(train)
    filled = derive(categorical_fill(train, candidates), columns)
    counted = [*candidates, *INTERACTION_TEXTS]
    stacked = filled.select(*counted).unpivot([], counted, "column", "value")
    counts = stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq"))
    counts = written(counts, "fit-counts", partition_by=["column"]).select("column", "value", "freq")
    sizes = {
        r["column"]: r
        for r in counts.groupBy("column")
        .agg(
            F.count_if(F.col("value") != MISSING).alias("distinct"),
            F.count(F.lit(1)).alias("values"),
            F.sum("freq").alias("rows"),
        )
        .collect()
    }
    rows = sizes[INTERACTION_TEXTS[0]]["rows"] if sizes else 0
    categorical = [
        c for c in candidates if not c.startswith("id_") or not rows or sizes[c]["distinct"] <= ID_CATEGORY_LIMIT
    ]
    numeric = [c for c in columns if c not in categorical]
    fitted = numeric_median_fit(train, numeric, rows=rows, task_rows=task_rows).collect()
    medians = {r["column"]: float(r["median"]) for r in fitted}
    frequencies = [c for c in FREQUENCY_COLUMNS if c in categorical]
    features = [*columns, *derived_names(numeric), *[f"{c}_frequency" for c in frequencies]]
    if len(set(features)) != len(features):
        raise ValueError("The feature set has duplicate names.")
    kept = counts.where(F.col("column").isin([*categorical, *INTERACTION_TEXTS]))
    values = {c: sizes[c]["values"] for c in [*categorical, *INTERACTION_TEXTS] if c in sizes}
    return FitState(numeric, categorical, {c: medians[c] for c in numeric}, kept, values, features, rows)


def _known(df: DataFrame, state: FitState, columns: list[str]) -> DataFrame:
    """Texts unseen in training -> unknown token; training counts of the frequency columns beside them.

    Most categories have few values: those become literals of one projection (a
    set for membership, a map for counts), which moves no data and keeps
    the stage small. Columns with many values are looked up together.
    """
    listed = state.small_values()

    def inline(c: str) -> bool:
        return len(listed.get(c, ())) <= (INLINE_COUNTS if c in FREQUENCY_COLUMNS else INLINE_VALUES) and (
            state.sizes.get(c, 0) <= INLINE_VALUES
        )

    names = list(df.columns)
    many = {c: F.col(c) for c in columns if not inline(c)}
    if many:
        df = looked_up(df, many, state.counts, "freq", prefix="_freq_", sizes=state.sizes, inline=0)

    def known(c: str) -> str:
        values = sorted({MISSING, UNKNOWN} | set(listed.get(c, ()) if inline(c) else ()))
        texts = ", ".join(quoted(v) for v in values)
        # A literal array is a short loop in the generated code, a long IN list a hash set; an unrolled
        # comparison per value would make the method too long for the JVM to compile.
        seen = f"array_contains(array({texts}), `{c}`)" if len(values) <= INLINE_COUNTS else f"`{c}` IN ({texts})"
        if not inline(c):
            seen = f"`_freq_{c}` IS NOT NULL OR {seen}"
        return f"CASE WHEN {seen} THEN `{c}` ELSE {quoted(UNKNOWN)} END AS `{c}`"

    def count(c: str) -> str:
        if not inline(c):
            return f"coalesce(`_freq_{c}`, {FREQUENCY_UNSEEN}L) AS `{c}_frequency`"
        pairs = ", ".join(f"{quoted(v)}, {n}L" for v, n in sorted(listed.get(c, {}).items(), key=lambda i: -i[1]))
        found = f"element_at(map({pairs}), `{c}`)" if pairs else "CAST(NULL AS BIGINT)"
        return f"coalesce({found}, {FREQUENCY_UNSEEN}L) AS `{c}_frequency`"

    return df.selectExpr(
        *[known(c) if c in columns else f"`{c}`" for c in names],
        *[count(c) for c in columns if c in FREQUENCY_COLUMNS],
    )


def transform(df: DataFrame, state: FitState, keep: list[str] | None = None) -> DataFrame:
    """Features in the frozen order, after the ``keep`` columns (key, label, split...)."""
    require_columns(df, REQUIRED_COLUMNS, "table to transform")
    kept = [c for c in (keep or []) if c in df.columns]
    held = {f"_keep_{c}": F.col(c) for c in kept}
    wanted = set(state.numeric) | set(state.categorical)
    raw = df.select(*[F.col(c) for c in df.columns if c in wanted], *[v.alias(k) for k, v in held.items()])
    present = [c for c in raw.columns if c in wanted]
    known = _known(prepare(raw, state.medians, state.categorical), state, state.categorical)
    full = _known(derive(known, present), state, INTERACTION_TEXTS)
    # A category column the table lacked is a missing-token column in the output.
    lacked = [c for c in FLAGGED_COLUMNS if c in state.categorical and c not in present]
    full = full.withColumns({c: F.lit(MISSING) for c in lacked}) if lacked else full
    named = align_feature_schema(full, [*held, *state.features], FREQUENCY_UNSEEN)
    return named.withColumnsRenamed({f"_keep_{c}": c for c in kept})


def _refuse_other_version(path: str, version: str) -> None:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    for other in ("v1", "v2"):
        if other != version and (name == other or name.endswith(f"_{other}")):
            raise ValueError(f"Unsafe {version} state path: {path} belongs to {other}.")


def save_state(state: FitState, path: str, metadata: dict | None = None, *, overwrite: bool = False) -> None:
    """Write the state below ``path``; an existing one is kept unless ``overwrite``."""
    _refuse_other_version(path, state.version)
    spark = state.counts.sparkSession
    if exists(spark, path) and not overwrite:
        raise FileExistsError(f"Refusing to overwrite existing state: {path}")
    mode = "overwrite" if overwrite else "errorifexists"
    state.counts.write.mode(mode).partitionBy("column").parquet(f"{path}/counts")
    document = {
        "version": state.version,
        "numeric": state.numeric,
        "categorical": state.categorical,
        "medians": state.medians,
        "sizes": state.sizes,
        "features": state.features,
        "rows": state.rows,
        "metadata": metadata or {},
    }
    one = spark.createDataFrame([(json.dumps(document),)], "value string")
    one.write.mode(mode).text(f"{path}/state")


def load_state(spark: SparkSession, path: str) -> FitState:
    if not exists(spark, f"{path}/state"):
        raise FileNotFoundError(f"No fitted state at {path}")
    document = json.loads(spark.read.text(f"{path}/state").first()[0])
    schema = "value string, freq bigint, column string"
    counts = spark.read.schema(schema).parquet(f"{path}/counts").select("column", "value", "freq")
    names = ("numeric", "categorical", "medians", "sizes", "features", "rows", "version")
    return FitState(counts=counts, extra=document["metadata"], **{n: document[n] for n in names})
