"""Table profiles: balance, missingness, numeric / categorical / identifier audits, label views.

Whole-table measures of all columns come from one conditional aggregate;
per-value measures come from one stacked (column, value) count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import day, hour, is_numeric, normalize_missing, number, ratio
from ledgerlens.operators.guards import ID_COLUMN, TARGET_COLUMN, TIME_COLUMN, column_groups
from ledgerlens.operators.ordered import column_quantiles, quantiles_from_counts
from ledgerlens.session import TASK_ROWS, written

NEAR_CONSTANT = 0.99
MANY_VALUES = 100
MANY_VALUES_SHARE = 0.05
MOSTLY_MISSING = 0.5


def class_balance(df: DataFrame, label: str = TARGET_COLUMN) -> DataFrame:
    """Rows and share per label, and negatives per positive."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy()
    negatives = F.sum(F.when(F.col(label) == 0, F.col("rows")).otherwise(0)).over(whole)
    positives = F.sum(F.when(F.col(label) == 1, F.col("rows")).otherwise(0)).over(whole)
    return counts.select(
        label,
        "rows",
        (F.col("rows") / F.sum("rows").over(whole)).alias("share"),
        ratio(negatives, positives).alias("imbalance_ratio"),
    )


def missing_summary(df: DataFrame, digits: int = 2) -> DataFrame:
    """(column, dtype, missing_count, missing_percent), one scan for all columns."""
    df = normalize_missing(df)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns], F.count(F.lit(1)).alias("_rows"))
    long = wide.unpivot(["_rows"], df.columns, "column", "missing_count")
    types = df.sparkSession.createDataFrame(list(df.dtypes), "column string, dtype string")
    return long.join(F.broadcast(types), "column").select(
        "column",
        "dtype",
        "missing_count",
        F.round(F.col("missing_count") * 100 / F.col("_rows"), digits).alias("missing_percent"),
    )


def missing_signal_strength(
    df: DataFrame, label: str = TARGET_COLUMN, min_missing_percent: float = 99.0
) -> DataFrame:
    """abs(label rate where null - where not null) of the columns missing more than the given percent."""
    df = normalize_missing(df)
    columns = [c for c in df.columns if c != label]
    measures = []
    for c in columns:
        null = F.col(c).isNull()
        measures.append(
            F.struct(
                F.count_if(null).alias("missing"),
                F.avg(F.when(null, F.col(label))).alias("when_null"),
                F.avg(F.when(~null, F.col(label))).alias("when_present"),
            ).alias(c)
        )
    wide = df.agg(*measures, F.count(F.lit(1)).alias("_rows"))
    long = wide.unpivot(["_rows"], columns, "column", "m")
    return long.where(
        (F.col("m.missing") * 100 / F.col("_rows") > min_missing_percent)
        & F.col("m.when_null").isNotNull()
        & F.col("m.when_present").isNotNull()
    ).select("column", F.abs(F.col("m.when_null") - F.col("m.when_present")).alias("fraud_rate_difference"))


def _stacked_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, rows) with null as a value; counted before the shuffle, written once for its readers."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = texts.unpivot([], columns, "column", "value").groupBy("column", "value")
    return written(counts.agg(F.count(F.lit(1)).alias("rows")), "stacked-counts")


def numeric_audit(df: DataFrame, columns: list[str], *, task_rows: int = TASK_ROWS) -> DataFrame:
    """Eighteen measures per column, text columns coerced to numbers.

    Everything but the quartile-dependent outlier count comes from the stacked
    value counts, so each distinct value is handled once; outliers are a second
    pass over the same counts once the quartiles are known.
    """
    dtypes = dict(df.dtypes)
    names = df.sparkSession.createDataFrame([(c, dtypes[c]) for c in columns], "column string, dtype string")
    counts = _stacked_counts(df, columns).withColumn("number", number("value"))
    known = F.col("value").isNotNull()
    measures = counts.groupBy("column").agg(
        F.sum("rows").alias("_rows"),
        F.coalesce(F.sum(F.when(~known, F.col("rows"))), F.lit(0)).alias("missing_count"),
        F.coalesce(F.sum(F.when(known & F.col("number").isNull(), F.col("rows"))), F.lit(0)).alias(
            "coercion_failure_count"
        ),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
        (
            F.sum(F.col("number") * F.col("rows")) / F.sum(F.when(F.col("number").isNotNull(), F.col("rows")))
        ).alias("mean"),
        F.coalesce(F.sum(F.when(F.col("number") < 0, F.col("rows"))), F.lit(0)).alias("negative_count"),
        F.count_if(known).alias("unique_count"),
        F.max(F.when(known, F.col("rows"))).alias("_top"),
    )
    # No further scan: the quantiles are ranked among the counted values, all columns at once.
    numbers = counts.where(F.col("number").isNotNull())
    points = quantiles_from_counts(
        numbers, ["column"], "number", "rows", [0.01, 0.25, 0.5, 0.75, 0.99], task_rows=task_rows
    )
    q = [F.try_element_at("quantiles", F.lit(i + 1)) for i in range(5)]
    spread = (q[3] - q[1]) * 3
    fences = points.select(
        "column",
        q[0].alias("q01"),
        q[2].alias("median"),
        q[4].alias("q99"),
        (q[1] - spread).alias("_lower"),
        (q[3] + spread).alias("_upper"),
    )
    outside = (F.col("number") < F.col("_lower")) | (F.col("number") > F.col("_upper"))
    outliers = (
        counts.where(F.col("number").isNotNull())
        .join(F.broadcast(fences.select("column", "_lower", "_upper")), "column")
        .groupBy("column")
        .agg(F.coalesce(F.sum(F.when(outside, F.col("rows"))), F.lit(0)).alias("iqr_outlier_count"))
    )
    present = F.col("_rows") - F.col("missing_count")
    top_rate = F.when(present > 0, F.col("_top") / present)
    return (
        names.join(measures, "column")
        .join(fences, "column", "left")
        .join(outliers, "column", "left")
        .select(
            "column",
            "dtype",
            "missing_count",
            (F.col("missing_count") / F.col("_rows")).alias("missing_rate"),
            "coercion_failure_count",
            ratio(F.col("coercion_failure_count"), present).alias("coercion_failure_rate"),
            "min",
            "max",
            "mean",
            "median",
            "negative_count",
            "q01",
            "q99",
            F.coalesce("iqr_outlier_count", F.lit(0)).alias("iqr_outlier_count"),
            "unique_count",
            top_rate.alias("top_value_rate"),
            (F.col("unique_count") <= 1).alias("constant"),
            F.coalesce(top_rate >= NEAR_CONSTANT, F.lit(False)).alias("near_constant"),
        )
    )


def audit_views(numeric: DataFrame) -> DataFrame:
    """(view, column): the numeric columns that deserve a look, by reason."""
    reasons = {
        "negative": F.col("negative_count") > 0,
        "constant": F.col("constant") | F.col("near_constant"),
        "high_missing": F.col("missing_rate") >= MOSTLY_MISSING,
    }
    views = F.array(*[F.when(condition, F.lit(name)) for name, condition in reasons.items()])
    return numeric.select(F.explode(F.filter(views, lambda v: v.isNotNull())).alias("view"), "column")


def value_kind(value: Column) -> Column:
    """Kind of a text value by its pattern (a Spark column has one type, its texts may not)."""
    return (
        F.when(F.rlike(value, F.lit(r"^[+-]?\d+$")), "int")
        .when(F.rlike(value, F.lit(r"^[+-]?(\d+\.\d*|\.\d+)([eE][+-]?\d+)?$")), "float")
        .when(F.lower(value).isin("true", "false"), "bool")
        .otherwise("str")
    )


def categorical_audit(df: DataFrame, columns: list[str], top_n: int = 5) -> DataFrame:
    """Distinct and missing counts, the most common values, cardinality and mixed-kind flags."""
    counts = _stacked_counts(df, columns)
    known = F.col("value").isNotNull()
    kinds = ("int", "float", "bool", "str")
    measures = counts.groupBy("column").agg(
        F.sum("rows").alias("_rows"),
        F.count_if(known).alias("unique_count"),
        F.coalesce(F.sum(F.when(~known, F.col("rows"))), F.lit(0)).alias("missing_count"),
        *[F.max(F.when(known & (value_kind(F.col("value")) == k), 1)).alias(f"_{k}") for k in kinds],
    )
    # Rank <= n over a window lets Spark keep n rows per column in each task before the shuffle.
    order = Window.partitionBy("column").orderBy(F.col("rows").desc(), F.col("value"))
    top = (
        counts.where(known)
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= top_n)
        .groupBy("column")
        .agg(F.sort_array(F.collect_list(F.struct("_rank", "value", "rows"))).alias("_top"))
        .select(
            "column",
            F.array_join(
                F.transform("_top", lambda t: F.concat_ws("=", t["value"], t["rows"].cast("string"))), "|"
            ).alias("top_values"),
        )
    )
    n_kinds = sum((F.coalesce(F.col(f"_{k}"), F.lit(0)) for k in kinds), F.lit(0))
    limit = F.greatest(F.lit(float(MANY_VALUES)), F.col("_rows") * MANY_VALUES_SHARE)
    return measures.join(top, "column", "left").select(
        "column",
        "unique_count",
        "missing_count",
        (F.col("missing_count") / F.col("_rows")).alias("missing_rate"),
        F.coalesce("top_values", F.lit("")).alias("top_values"),
        (F.col("unique_count") > limit).alias("high_cardinality"),
        (n_kinds > 1).alias("mixed_kinds"),
    )


def id_like_audit(df: DataFrame) -> DataFrame:
    """Identifier-like columns: distinct rate, unique flag, recommended treatment."""
    columns = [r["column"] for r in column_groups(df.limit(0)).where("id_like").collect()]
    measures = _stacked_counts(df, columns).groupBy("column").agg(
        F.sum("rows").alias("_rows"),
        F.count("value").alias("unique_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("rows"))), F.lit(0)).alias("missing_count"),
    )
    name = F.col("column")
    treatment = (
        F.when(name == ID_COLUMN, "ignored")
        .when(name.startswith("id_"), F.when(F.col("unique_count") < 1000, "categorical").otherwise("monitored"))
        .otherwise("categorical")
    )
    return measures.select(
        "column",
        "unique_count",
        (F.col("unique_count") / F.col("_rows")).alias("unique_rate"),
        "missing_count",
        (F.col("missing_count") / F.col("_rows")).alias("missing_rate"),
        (F.col("unique_count") == F.col("_rows")).alias("behaves_like_unique_id"),
        treatment.alias("recommended_treatment"),
    )


def describe(df: DataFrame, column: str, *, task_rows: int = TASK_ROWS) -> DataFrame:
    """count, mean, std, min, quartiles and max of one column: one row."""
    values = df.select(number(column).alias(column))
    quartiles = column_quantiles(values, [column], [0.25, 0.5, 0.75], task_rows=task_rows)
    basic = values.agg(
        F.lit(column).alias("column"),
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    q = [F.try_element_at("quantiles", F.lit(i)) for i in (1, 2, 3)]
    one = basic.withColumn("quantiles", quartiles.select("quantiles").scalar())
    return one.select(
        "column", "count", "mean", "std", "min", q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), "max"
    )


def label_rate_by_period(
    df: DataFrame, period: str = "day", time: str = TIME_COLUMN, label: str = TARGET_COLUMN
) -> DataFrame:
    """Rows and label mean per day or hour of day."""
    part = day(time) if period == "day" else hour(time)
    return df.groupBy(part.alias(period)).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(label).alias("label_rate")
    )


def mean_shift(df: DataFrame, feature: str, split: str = "split", label: str = TARGET_COLUMN) -> DataFrame:
    """Feature mean per split and per class, in one scan: (view, group, feature_mean)."""
    views = F.array(
        F.struct(F.lit("split").alias("view"), F.col(split).cast("string").alias("group")),
        F.struct(F.lit("class").alias("view"), F.col(label).cast("string").alias("group")),
    )
    return (
        df.select(number(feature).alias("_x"), F.explode(views).alias("_v"))
        .groupBy("_v.view", "_v.group")
        .agg(F.avg("_x").alias("feature_mean"))
    )


def label_correlation_topk(df: DataFrame, label: str = TARGET_COLUMN, k: int = 10) -> DataFrame:
    """Pearson correlation of each numeric column with the label (rows where both are known), top k."""
    columns = [f.name for f in df.schema.fields if is_numeric(f.dataType)]

    def correlation(c: str) -> Column:
        both = number(c).isNotNull() & number(label).isNotNull()
        x, y = F.when(both, number(c)), F.when(both, number(label))
        # A constant column has none (the built-in corr divides by zero there).
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    wide = df.agg(*[correlation(c).alias(c) for c in columns])
    return (
        wide.unpivot([], columns, "column", "correlation")
        .where(F.col("correlation").isNotNull() & ~F.isnan("correlation"))
        .orderBy(F.col("correlation").desc(), "column")
        .limit(k)
    )


def scale_pos_weight(df: DataFrame, label: str = TARGET_COLUMN) -> DataFrame:
    """Negatives per positive and the ordered candidate weights; a missing class is an error."""
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives")
    )
    empty = (F.col("positives") == 0) | (F.col("negatives") == 0)
    weight = F.when(
        empty, F.raise_error(F.lit("Cannot calculate a class weight with an empty class.")).cast("double")
    ).otherwise(F.col("negatives") / F.col("positives"))
    weighted = counts.withColumn("scale_pos_weight", weight)
    bases = [F.lit(1.0), F.lit(3.0), F.lit(5.0), F.sqrt("scale_pos_weight"), F.lit(10.0)]
    candidates = F.array_distinct(F.array(*[F.round(b, 4) for b in bases]))
    return weighted.withColumn("candidate_weights", candidates)


def latency_summary(
    log: DataFrame,
    group: list[str],
    latency: str = "latency_ms",
    status: str = "status",
    time: str = "ts",
    *,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Latency of the successful requests, error rate and successes per second, per group."""
    ok = F.col(status) == "success"
    seconds = F.col("_last") - F.col("_first")
    basic = log.withColumn("_t", F.unix_micros(F.col(time).cast("timestamp")) / 1e6).groupBy(*group).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.count_if(ok).alias("successful_requests"),
        F.count_if(~ok).alias("failed_requests"),
        F.min(F.when(ok, F.col(latency))).alias("min_ms"),
        F.avg(F.when(ok, F.col(latency))).alias("mean_ms"),
        F.max(F.when(ok, F.col(latency))).alias("max_ms"),
        F.min("_t").alias("_first"),
        F.max("_t").alias("_last"),
    )
    # A few groups each hold many requests: count equal latencies first, then select by rank.
    counts = log.where(ok).groupBy(*group, latency).agg(F.count(F.lit(1)).alias("rows"))
    points = quantiles_from_counts(counts, group, latency, "rows", [0.5, 0.95, 0.99], task_rows=task_rows)
    p = [F.coalesce(F.try_element_at("quantiles", F.lit(i)), F.lit(0.0)) for i in (1, 2, 3)]
    return basic.join(points, group, "left").select(
        *group,
        "request_count",
        "successful_requests",
        "failed_requests",
        ratio(F.col("failed_requests"), F.col("request_count")).alias("error_rate"),
        F.coalesce("min_ms", F.lit(0.0)).alias("min_ms"),
        F.coalesce("mean_ms", F.lit(0.0)).alias("mean_ms"),
        p[0].alias("p50_ms"),
        p[1].alias("p95_ms"),
        p[2].alias("p99_ms"),
        F.coalesce("max_ms", F.lit(0.0)).alias("max_ms"),
        ratio(F.col("successful_requests"), seconds).alias("throughput_rps"),
    )


