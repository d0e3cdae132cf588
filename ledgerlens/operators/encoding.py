"""Fitted statistics (frequencies, medians, vocabularies, entity statistics) and their application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import MISSING, UNKNOWN, deviation, is_numeric, number, text, uid
from ledgerlens.operators.enrich import lookup_map
from ledgerlens.operators.lookups import looked_up
from ledgerlens.operators.ordered import column_quantiles, group_quantiles, largest_group, running_totals
from ledgerlens.session import TASK_ROWS, written


def frequency_fit(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, freq) for every value of every column; null is a value with a count.

    One scan: the columns are stacked and counted together, map-side first.
    """
    stacked = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    return stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq"))


def frequency_encode(
    df: DataFrame, state: DataFrame, columns: list[str], suffix: str = "_freq", *, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Attach ``<column><suffix>`` counts from a written state table; unseen values get 0."""
    found = looked_up(df, {c: F.col(c) for c in columns}, state, "freq", prefix="_freq_", task_rows=task_rows)
    counts = {f"{c}{suffix}": F.coalesce(F.col(f"_freq_{c}"), F.lit(0)) for c in columns}
    return found.withColumns(counts).drop(*[f"_freq_{c}" for c in columns])


def numeric_median_fit(
    df: DataFrame, columns: list[str], *, rows: int | None = None, task_rows: int = TASK_ROWS
) -> DataFrame:
    """(column, median) with 0.0 for an all-null column; exact at any size."""
    numbers = df.select(*[number(c).alias(c) for c in columns])
    found = column_quantiles(numbers, columns, [0.5], rows=rows, task_rows=task_rows)
    return found.select("column", F.coalesce(F.try_element_at("quantiles", F.lit(1)), F.lit(0.0)).alias("median"))


def category_vocab_fit(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value): the texts seen in training plus the missing and unknown tokens."""
    stacked = df.select(*[text(c).alias(c) for c in columns]).unpivot([], columns, "column", "value").distinct()
    names = df.sparkSession.createDataFrame([(c, t) for c in columns for t in (MISSING, UNKNOWN)], stacked.schema)
    return stacked.unionByName(names).distinct()


UID_STATS = ["uid_txn_count", "uid_amt_mean", "uid_amt_std", "uid_amt_median"]


def uid_stats_fit(
    df: DataFrame,
    key: Column | None = None,
    amount: str = "TransactionAmt",
    *,
    single_row_std: float | None = 0.0,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Per uid: row count, mean, sample std and exact median of the amount.

    The std of a single amount is ``single_row_std`` (None leaves it null).
    """
    keyed = df.select((uid() if key is None else key).alias("uid"), F.col(amount).alias("_amount"))
    std = F.stddev_samp("_amount")
    basic = [
        F.count(F.lit(1)).alias("uid_txn_count"),
        F.avg("_amount").alias("uid_amt_mean"),
        (std if single_row_std is None else F.coalesce(std, F.lit(single_row_std))).alias("uid_amt_std"),
    ]
    if largest_group(keyed, ["uid"]) <= task_rows:
        return keyed.groupBy("uid").agg(*basic, F.percentile("_amount", 0.5).alias("uid_amt_median"))
    medians = group_quantiles(keyed, ["uid"], "_amount", [0.5], task_rows=task_rows)
    median = F.try_element_at("quantiles", F.lit(1)).alias("uid_amt_median")
    return keyed.groupBy("uid").agg(*basic).join(medians.select("uid", median), "uid", "left")


def amount_totals(df: DataFrame, amount: str = "TransactionAmt") -> tuple[float, float]:
    """Global mean and sample std; the std falls back to 1.0 when it is zero."""
    row = df.agg(F.avg(amount), F.stddev_samp(amount)).first()
    return (row[0] if row[0] is not None else 0.0), (row[1] or 1.0)


def attach_uid_stats(
    df: DataFrame, stats: DataFrame, key: Column | None = None, *, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Left join of the entity statistics that no heavy entity can skew."""
    values = {n: (n, None) for n in UID_STATS}
    # The built-in key is never null; another one may be.
    own = uid() if key is None else key
    return lookup_map(
        df, own, stats, "uid", values, rows="uid_txn_count", null_keys=key is not None, task_rows=task_rows
    )


def uid_stats_apply(
    df: DataFrame,
    stats: DataFrame,
    global_mean: float,
    global_std: float,
    key: Column | None = None,
    amount: str = "TransactionAmt",
) -> DataFrame:
    """Attach entity statistics with their fallbacks, and the deviation of the amount."""
    defaults = dict(zip(UID_STATS, [F.lit(1), F.lit(global_mean), F.lit(global_std), F.lit(global_mean)]))
    filled = attach_uid_stats(df, stats, key).withColumns(
        {n: F.coalesce(F.col(n), default) for n, default in defaults.items()}
    )
    return filled.withColumn("uid_amt_deviation", deviation(amount, "uid_amt_mean", "uid_amt_std"))


def uid_window_stats(
    df: DataFrame, key: Column | None = None, amount: str = "TransactionAmt", *, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Entity statistics of the table itself on each of its rows, no fallbacks.

    Group and join back, not a window: no task ever holds all rows of an entity.
    """
    stats = written(uid_stats_fit(df, key, amount, single_row_std=None, task_rows=task_rows), "entity-stats")
    return attach_uid_stats(df, stats, key).withColumn(
        "uid_amt_deviation", deviation(amount, "uid_amt_mean", "uid_amt_std")
    )


def numeric_coerce_impute(
    df: DataFrame, medians: dict[str, float], suffix: str = "_was_missing", indicators: bool = True
) -> DataFrame:
    """Text to number, missing indicator, median fill; all columns in one projection.

    A column the table lacks is filled with its median and counts as present (indicator 0).
    """
    filled, flags = {}, {}
    for c, median in medians.items():
        value = number(c) if c in df.columns else F.lit(float(median))
        filled[c] = F.coalesce(value, F.lit(float(median)))
        flags[f"{c}{suffix}"] = value.isNull().cast("int")
    return df.withColumns({**filled, **flags} if indicators else filled)


def categorical_fill(
    df: DataFrame, columns: list[str], vocabulary: DataFrame | None = None, *, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Null -> missing token; with a written vocabulary, unseen text -> unknown token.

    The missing token, which may fill most rows, is known without a lookup.
    """
    df = df.withColumns({c: text(c) if c in df.columns else F.lit(MISSING) for c in columns})
    if vocabulary is None:
        return df
    keys = {c: F.when(F.col(c) != MISSING, F.col(c)) for c in columns}
    known = looked_up(df, keys, vocabulary.withColumn("_one", F.lit(1)), "_one", prefix="_known_", task_rows=task_rows)
    kept = {c: F.when((F.col(c) == MISSING) | F.col(f"_known_{c}").isNotNull(), F.col(c)).otherwise(UNKNOWN) for c in columns}
    return known.withColumns(kept).drop(*[f"_known_{c}" for c in columns])


# The columns whose absence is a signal of its own.
FLAGGED_COLUMNS = ["DeviceInfo", "DeviceType", "R_emaildomain", "P_emaildomain"]
HIGH_IDENTITY_MISSING = 21


def missing_flag(df: DataFrame, column: str) -> Column:
    """1 for null or the missing token, and for a column that is not there at all."""
    if column not in df.columns:
        return F.lit(1)
    value = F.col(column)
    return (value.isNull() | (value.cast("string") == MISSING)).cast("int")


def missing_flags(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.withColumns({f"{c}_missing_flag": missing_flag(df, c) for c in columns or FLAGGED_COLUMNS})


def identity_missingness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """How many ``id_*`` values a row lacks, as count, ratio and high flag."""
    columns = [c for c in df.columns if c.startswith("id_")] if columns is None else columns
    count = F.lit(0)
    for c in columns:
        count = count + missing_flag(df, c)
    share = count / F.lit(len(columns)) if columns else F.lit(0.0)
    return df.withColumns(
        {
            "identity_missing_count": count,
            "identity_missing_ratio": share.cast("double"),
            "high_identity_missing_flag": (count >= HIGH_IDENTITY_MISSING).cast("int"),
        }
    )


def interaction_columns(df: DataFrame) -> dict[str, Column]:
    """The product flag and the five crossed texts, from filled category columns."""

    def safe(c: str) -> Column:
        return text(c) if c in df.columns else F.lit(MISSING)

    def crossed(c: str) -> Column:
        return F.concat(safe("ProductCD"), F.lit(f"__{c}_missing_"), missing_flag(df, c).cast("string"))

    return {
        "ProductCD_W_flag": (safe("ProductCD") == "W").cast("int"),
        "ProductCD_DeviceType_missing_interaction": crossed("DeviceType"),
        "ProductCD_DeviceInfo_missing_interaction": crossed("DeviceInfo"),
        "ProductCD_R_emaildomain_missing_interaction": crossed("R_emaildomain"),
        "card3_addr2_interaction": F.concat_ws("__", safe("card3"), safe("addr2")),
        "card4_card6_interaction": F.concat_ws("__", safe("card4"), safe("card6")),
    }


def interactions(df: DataFrame) -> DataFrame:
    return df.withColumns(interaction_columns(df))


def category_union(splits: list[DataFrame], columns: list[str], *, task_rows: int = TASK_ROWS) -> DataFrame:
    """(column, value, index): sorted union of values over the splits, indexed from 0 per column.

    The index is a running total over distinct values, so a column with very
    many values is numbered by ranges in parallel.
    """
    stacked = None
    for split in splits:
        part = (
            split.select(*[F.col(c).cast("string").alias(c) for c in columns])
            .unpivot([], columns, "column", "value")
            .where(F.col("value").isNotNull())
            .distinct()
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    counted = stacked.distinct().withColumn("one", F.lit(1).cast("bigint"))
    indexed = running_totals(counted, ["column"], "value", ["one"], task_rows=task_rows)
    return indexed.select("column", "value", (F.col("one_upto") - 1).alias("index"))


def ordinal_standardize(train: DataFrame, other: DataFrame, key: str, *, task_rows: int = TASK_ROWS) -> DataFrame:
    """Compact numeric matrix of ``other`` with state fitted on ``train``; width and order stay.

    Texts become their 1-based sorted position in training (unseen 0); numbers are
    mean-filled and scaled by the sample std (1 where it is null or zero).
    """
    features = [f for f in train.schema.fields if f.name != key]
    texts = [f.name for f in features if not is_numeric(f.dataType)]
    numbers = [f.name for f in features if is_numeric(f.dataType)]
    result = other
    if texts:
        filled = train.select(*[text(c).alias(c) for c in texts])
        codes = written(category_union([filled], texts, task_rows=task_rows), "codes")
        result = looked_up(other, {c: text(c) for c in texts}, codes, "index", prefix="_code_", task_rows=task_rows)
        coded = {c: F.coalesce(F.col(f"_code_{c}") + 1, F.lit(0)).cast("float") for c in texts}
        result = result.withColumns(coded).drop(*[f"_code_{c}" for c in texts])
    if numbers:
        stats = train.agg(
            *[F.avg(number(c)).alias(f"m_{c}") for c in numbers],
            *[F.stddev_samp(number(c)).alias(f"s_{c}") for c in numbers],
        ).first()
        scaled = {}
        for c in numbers:
            mean = stats[f"m_{c}"] if stats[f"m_{c}"] is not None else 0.0
            std = stats[f"s_{c}"] or 1.0
            scaled[c] = ((F.coalesce(number(c), F.lit(mean)) - F.lit(mean)) / F.lit(std)).cast("float")
        result = result.withColumns(scaled)
    return result.select(key, *[f.name for f in features])
