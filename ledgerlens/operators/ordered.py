"""Exact order statistics and running totals that never need one big task.

Both start from a table with one row per (group, value): duplicates collapse
map-side before anything is shuffled. While that table is small one window per
group is enough; past TASK_ROWS the values are cut into ranges, each range is
summed on its own, and the totals of the earlier ranges are added as an offset.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import TASK_ROWS, written

SKETCH_ACCURACY = 2_000


def running_totals(
    counts: DataFrame,
    group: list[str],
    value: str,
    sums: list[str],
    *,
    descending: bool = False,
    stored: bool = False,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``<c>_upto``: the sum of c over this and all earlier values of the group.

    ``counts`` holds one row per (group, value). It is written once, so that its
    size, its cut points and its totals do not compute it again; ``stored`` says
    that it already is a written table.
    """
    table = counts if stored else written(counts, "running-totals")
    rows = table.count()
    order = F.col(value).desc() if descending else F.col(value).asc()
    keys = [F.col(c) for c in group] or [F.lit(0)]
    if rows <= task_rows:
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return table.withColumns({f"{c}_upto": F.sum(c).over(window) for c in sums})

    # Ranges of about ``task_rows`` rows, as many as it takes; written, so that both readers see the same ranges.
    pieces = math.ceil(rows / task_rows)
    ranged = table.repartitionByRange(pieces, *group, value).withColumn("_range", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    totals = ranged.groupBy(*group, "_range").agg(*[F.sum(c).alias(f"_{c}_total") for c in sums])
    # One row per group and range: at most the number of ranges per group, whatever the rows.
    range_order = F.col("_range").desc() if descending else F.col("_range").asc()
    earlier = Window.partitionBy(*keys).orderBy(range_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_at_{c}") for c in [*group, "_range"]],
        *[F.coalesce(F.sum(f"_{c}_total").over(earlier), F.lit(0)).alias(f"_{c}_before") for c in sums],
    )
    within = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({f"_{c}_local": F.sum(c).over(within) for c in sums})
    same = [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in [*group, "_range"]]
    joined = local.join(offsets, same, "left")
    return joined.select(
        *table.columns, *[(F.col(f"_{c}_local") + F.col(f"_{c}_before")).alias(f"{c}_upto") for c in sums]
    )


def value_counts(df: DataFrame, group: list[str], value: str, weight: str = "rows") -> DataFrame:
    return df.groupBy(*group, value).agg(F.count(F.lit(1)).alias(weight))


def quantiles_from_counts(
    counts: DataFrame,
    group: list[str],
    value: str,
    weight: str,
    probabilities: Sequence[float],
    *,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group -> (group..., quantiles array).

    Position p*(n-1) between the two neighbouring order statistics, the numpy and
    pandas default. Null values are not counted; group keys must not be null.
    """
    known = written(counts.where(F.col(value).isNotNull()), "value-counts")
    upto = running_totals(known, group, value, [weight], stored=True, task_rows=task_rows)
    sizes = known.groupBy(*group).agg(F.sum(weight).alias("_n"))
    ranked = upto.join(sizes, group) if group else upto.withColumn("_n", sizes.scalar())
    before = F.col(f"{weight}_upto") - F.col(weight)

    def at(rank: Column) -> Column:
        return F.max(F.when((before <= rank) & (rank < F.col(f"{weight}_upto")), F.col(value).cast("double")))

    position = [F.lit(float(p)) * (F.col("_n") - 1) for p in probabilities]
    found = ranked.groupBy(*group).agg(
        F.max("_n").alias("_n"),
        *[at(F.floor(p)).alias(f"_low{i}") for i, p in enumerate(position)],
        *[at(F.ceil(p)).alias(f"_high{i}") for i, p in enumerate(position)],
    )
    values = [_between(f"_low{i}", f"_high{i}", p) for i, p in enumerate(position)]
    return found.select(*group, F.array(*values).alias("quantiles"))


def _between(low: str, high: str, position: Column) -> Column:
    return F.col(low) + (F.col(high) - F.col(low)) * (position - F.floor(position))


def column_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: Sequence[float],
    *,
    rows: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Exact quantiles of many numeric columns -> (column, quantiles); all-null columns give nulls.

    While all values of all columns fit one task (``rows``, else counted, times columns), the built-in exact aggregate
    serves. Beyond, it takes two scans, however many columns there are: sketches bracket every wanted rank, then values
    inside a bracket are counted one by one and those between brackets in bulk, and the ranks are selected among them.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, quantiles array<double>")
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    rows = numbers.count() if rows is None else rows
    if rows * len(columns) > task_rows:
        return _bracketed_quantiles(numbers, columns, probabilities, task_rows)
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    wide = numbers.agg(*[F.percentile(F.col(c), points).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "quantiles")


def _cells(numbers: DataFrame, columns: list[str]) -> DataFrame:
    return numbers.unpivot([], columns, "column", "x").where(F.col("x").isNotNull())


def _brackets(cells: DataFrame, probabilities: Sequence[float]) -> dict[str, tuple[int, list[float], list[float]]]:
    """column -> (values, starts, ends) of disjoint intervals in order that should hold the wanted ranks."""
    slack = 2.0 / SKETCH_ACCURACY
    low = [max(0.0, p - slack) for p in probabilities]
    high = [min(1.0, p + slack) for p in probabilities]
    points = F.array(*[F.lit(float(p)) for p in low + high])
    sketches = cells.groupBy("column").agg(
        F.count("x").alias("n"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        F.percentile_approx("x", points, SKETCH_ACCURACY).alias("at"),
    )
    found = {}
    for row in sketches.collect():  # one row of 2 * len(probabilities) numbers per column
        k = len(low)
        ends = [
            (row["min"] if p <= slack else row["at"][i], row["max"] if p >= 1 - slack else row["at"][k + i])
            for i, p in enumerate(probabilities)
        ]
        merged: list[list[float]] = []
        for a, b in sorted(ends):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        found[row["column"]] = (row["n"], [a for a, _ in merged], [b for _, b in merged])
    return found


def _bracketed_quantiles(
    numbers: DataFrame, columns: list[str], probabilities: Sequence[float], task_rows: int
) -> DataFrame:
    spark = numbers.sparkSession
    cells = _cells(numbers, columns)
    brackets = _brackets(cells, probabilities)
    edges = spark.createDataFrame(
        [(c, starts, ends) for c, (_, starts, ends) in brackets.items()],
        "_c string, _starts array<double>, _ends array<double>",
    )
    # A value stands inside the last interval that begins at or before it, or in the gap behind that interval. A gap's
    # values are counted in bulk, under the end of the interval before it.
    placed = cells.join(F.broadcast(edges), F.col("column") == F.col("_c"))
    last = F.size(F.filter("_starts", lambda s: s <= F.col("x")))
    end = F.when(last > 0, F.get("_ends", last - 1))
    inside = F.coalesce(F.col("x") <= end, F.lit(False))
    place = F.struct(F.when(inside, F.col("x")).otherwise(end).alias("x"), F.when(inside, 0).otherwise(1).alias("gap"))
    counts = written(placed.groupBy("column", place.alias("at")).agg(F.count(F.lit(1)).alias("rows")), "brackets")
    upto = running_totals(counts, ["column"], "at", ["rows"], stored=True, task_rows=task_rows)
    ranks = [(c, i, float(p) * (n - 1)) for c, (n, _, _) in brackets.items() for i, p in enumerate(probabilities)]
    wanted = spark.createDataFrame(ranks, "column string, i int, position double")
    start = F.col("rows_upto") - F.col("rows")

    def at(rank: Column) -> Column:
        here = (start <= rank) & (rank < F.col("rows_upto")) & (F.col("at.gap") == 0)
        return F.max(F.when(here, F.col("at.x")))

    # Of the counted values a rank meets those of its own column; most are left out before the aggregate.
    near = (F.floor("position") < F.col("rows_upto")) & (F.ceil("position") >= start)
    found = (
        upto.join(F.broadcast(wanted), "column")
        .where(near)
        .groupBy("column", "i", "position")
        .agg(at(F.floor("position")).alias("low"), at(F.ceil("position")).alias("high"))
        .withColumn("q", _between("low", "high", F.col("position")))
        .collect()
    )
    values = {(r["column"], r["i"]): r["q"] for r in found if r["q"] is not None}
    every = range(len(probabilities))
    missed = [c for c in brackets if any((c, i) not in values for i in every)]
    result = [
        (c, [values[c, i] for i in every] if c in brackets else None) for c in columns if c not in missed
    ]
    table = spark.createDataFrame(result, "column string, quantiles array<double>")
    if missed:
        # A sketch that did not enclose its rank: count all values of those columns instead.
        counted = value_counts(cells.where(F.col("column").isin(missed)), ["column"], "x")
        exact = quantiles_from_counts(counted, ["column"], "x", "rows", probabilities, task_rows=task_rows)
        table = table.unionByName(exact)
    return table


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Row count of the most frequent key (0 for no rows)."""
    row = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()
    return row[0] or 0


def group_quantiles(
    df: DataFrame, keys: list[str], value: str, probabilities: Sequence[float], *, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Exact quantiles of ``value`` per key -> (keys..., quantiles); keys must not be null.

    The built-in aggregate keeps all distinct values of a key in one buffer, so
    it serves the keys of at most ``task_rows`` rows. The others, at most total
    rows / task_rows of them, are set apart by broadcast and counted by value.
    """
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    in_task = F.percentile(F.col(value).cast("double"), points).alias("quantiles")
    if largest_group(df, keys) <= task_rows:
        return df.groupBy(*keys).agg(in_task)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    heavy = written(sizes.where(F.col("_rows") > task_rows).select(*keys), "heavy-keys")
    light = df.join(F.broadcast(heavy), keys, "left_anti").groupBy(*keys).agg(in_task)
    counts = value_counts(df.join(F.broadcast(heavy), keys, "left_semi"), keys, value)
    found = quantiles_from_counts(counts, keys, value, "rows", probabilities, task_rows=task_rows)
    return light.unionByName(heavy.join(found, keys, "left"))


def values_at_ranks(
    counts: DataFrame, value: str, ranks: Sequence[int], weight: str = "rows", *, task_rows: int = TASK_ROWS
) -> list[tuple]:
    """For each 0-based rank: (value at that rank, rows with a smaller value).

    ``counts`` is a written (value, weight) table; one row per rank is collected.
    """
    upto = running_totals(counts, [], value, [weight], stored=True, task_rows=task_rows)
    end = F.col(f"{weight}_upto")
    start = end - F.col(weight)
    holds = F.lit(False)
    for rank in set(ranks):
        holds = holds | ((start <= rank) & (F.lit(rank) < end))
    rows = upto.where(holds).select(F.col(value).alias("v"), start.alias("start"), end.alias("end")).collect()
    return [next((r["v"], r["start"]) for r in rows if r["start"] <= rank < r["end"]) for rank in ranks]
