"""Schema checks, projections and row flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import is_numeric

# Raw columns both feature engines need, and helper columns they drop.
REQUIRED_COLUMNS = ["TransactionDT", "TransactionAmt", "card1", "card2", "card3", "card4", "addr1"]
HELPER_COLUMNS = ["uid", "uid_next_dt", "uid_prev_dt", "uid_time_to_next"]
ID_COLUMN = "TransactionID"
TIME_COLUMN = "TransactionDT"
TARGET_COLUMN = "isFraud"
ID_CATEGORY_LIMIT = 1000


class SchemaError(ValueError):
    """A table lacks columns an operator needs, or holds columns it must not."""


def require_columns(df: DataFrame, columns: list[str], what: str = "input") -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise SchemaError(f"Missing required columns in {what}: {absent}")
    return df


def drop_non_features(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    return df.drop(ID_COLUMN, TARGET_COLUMN, *HELPER_COLUMNS, *(extra or []))


def separate_target(
    df: DataFrame, key: str = ID_COLUMN, target: str = TARGET_COLUMN
) -> tuple[DataFrame, DataFrame]:
    """Features with the key, and the label with the key (rows pair up by key)."""
    require_columns(df, [key, target], "labelled table")
    return df.drop(target), df.select(key, target)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Keep the columns with at least one value; one scan, one count per column."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def align_feature_schema(df: DataFrame, features: list[str], fill: float = 0) -> DataFrame:
    """Impose the frozen column order; absent features become ``fill``."""
    if len(set(features)) != len(features):
        raise SchemaError("The feature list has duplicate names")
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in features])


def check_feature_contract(df: DataFrame, features: list[str]) -> DataFrame:
    """Violations of a feature contract -> (check, column, violations), empty when it holds.

    Absent and extra columns and the column count are read from the schema; nulls and
    non-finite numbers are counted for all columns in one scan.
    """
    absent = [c for c in features if c not in df.columns]
    extra = [c for c in df.columns if c not in set(features)]
    found = [("absent", c, 1) for c in absent] + [("extra", c, 1) for c in extra]
    if len(df.columns) != len(features):
        found.append(("count", "*", abs(len(df.columns) - len(features))))
    if not absent and not extra and df.columns != features:
        found.append(("order", "*", sum(a != b for a, b in zip(df.columns, features))))
    schema_rows = df.sparkSession.createDataFrame(found, "check string, column string, violations bigint")
    present = [f for f in df.schema.fields if f.name in set(features)]
    if not present:
        return schema_rows
    checks = []
    for field in present:
        value = F.col(field.name)
        checks.append(F.count_if(value.isNull()).alias(f"null|{field.name}"))
        if field.dataType.typeName() in ("double", "float"):
            bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
            checks.append(F.count_if(bad).alias(f"non_finite|{field.name}"))
    wide = df.agg(*checks)
    long = wide.unpivot([], wide.columns, "name", "violations").where(F.col("violations") > 0)
    values = long.select(
        F.split_part("name", F.lit("|"), F.lit(1)).alias("check"),
        F.split_part("name", F.lit("|"), F.lit(2)).alias("column"),
        "violations",
    )
    return schema_rows.unionByName(values)


def fail_on_violations(df: DataFrame, features: list[str]) -> DataFrame:
    """Fail closed: raise when the contract is broken, else pass the rows through."""
    broken = check_feature_contract(df, features).limit(10).collect()
    if broken:
        raise SchemaError(f"Feature contract broken: {[tuple(row) for row in broken]}")
    return df


def same_columns(*splits: DataFrame) -> None:
    for split in splits[1:]:
        if split.columns != splits[0].columns:
            raise SchemaError("Split feature columns do not match the training columns")


def apply_threshold(
    df: DataFrame,
    threshold: float,
    score: str = "score",
    *,
    version: str | None = None,
    family: str | None = None,
) -> DataFrame:
    """Binary decision score >= threshold, with the policy that made it."""
    columns = {
        "fraud_prediction": (F.col(score) >= F.lit(threshold)).cast("int"),
        "threshold": F.lit(float(threshold)),
    }
    if version is not None:
        columns["model_version"] = F.lit(version)
    if family is not None:
        columns["model_family"] = F.lit(family)
    return df.withColumns(columns)


def filter_by_key(df: DataFrame, equals: dict, columns: list[str]) -> DataFrame:
    condition = F.lit(True)
    for name, value in equals.items():
        condition = condition & (F.col(name) == F.lit(value))
    return df.where(condition).select(*columns)


def column_groups(df: DataFrame) -> DataFrame:
    """Each column's kind, whether it looks like an identifier, and its treatment as a feature."""
    names = df.columns
    id_columns = [c for c in names if c.startswith("id_")]
    if id_columns:
        # Stacked pairs collapse in every task; a distinct count per column would copy each row once per column.
        texts = df.select(*[F.col(c).cast("string").alias(c) for c in id_columns])
        pairs = texts.unpivot([], id_columns, "column", "value").distinct()
        distinct = pairs.groupBy("column").agg(F.count("value").alias("distinct_values"))
    else:
        distinct = df.sparkSession.createDataFrame([], "column string, distinct_values bigint")
    rows = [
        (
            f.name,
            "numeric" if is_numeric(f.dataType) else "categorical",
            f.name == ID_COLUMN or f.name.startswith(("card", "addr", "id_")),
        )
        for f in df.schema.fields
    ]
    columns = df.sparkSession.createDataFrame(rows, "column string, kind string, id_like boolean")
    name = F.col("column")
    treated = (
        F.when(name.startswith("card") | name.startswith("addr"), "categorical")
        .when(name.startswith("id_") & (F.col("distinct_values") <= ID_CATEGORY_LIMIT), "categorical")
        .when(name.startswith("id_"), "numeric")
        .otherwise(F.col("kind"))
    )
    return columns.join(distinct, "column", "left").select("column", "kind", "id_like", treated.alias("feature_kind"))
