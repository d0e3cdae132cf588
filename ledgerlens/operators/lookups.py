"""Many columns looked up in one fitted (column, value, payload) table at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import TASK_ROWS, written

INLINE_VALUES = 64  # values of one column that may stand in the plan as a map
BROADCAST_BUDGET = 400_000  # values of all columns that one call broadcasts together: some 40 MB of text
BUCKETS = 1 << 16  # of (column, text) hashes, to find texts that may be too many for one task


def quoted(value: str) -> str:
    """A text as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def value_sizes(state: DataFrame) -> dict[str, int]:
    """Fitted values per column of a written state table: one number per column."""
    return {r["column"]: r["n"] for r in state.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}


def _literal(value) -> str:
    return quoted(value) if isinstance(value, str) else f"{int(value)}L"


def looked_up(
    df: DataFrame,
    keys: dict[str, Column],
    table: DataFrame,
    payload: str,
    *,
    prefix: str = "_found_",
    sizes: dict[str, int] | None = None,
    task_rows: int = TASK_ROWS,
    inline: int = INLINE_VALUES,
    budget: int = BROADCAST_BUDGET,
) -> DataFrame:
    """``df`` with ``<prefix><column>``: the payload (integer or text) of each key's text, null when unseen.

    ``table`` is a written (column, value, payload) table, one row per value; a null key finds the row with a null value.
    ``sizes``, its values per column, are counted unless given.

    Columns of few values become literal maps, the next smallest are broadcast while their values together keep to
    ``budget``. All others are looked up in one go: their texts, stacked as (row, column, value), meet the table once, are
    put together again per row, and the rows are shuffled once to meet them, however many columns there are. Texts on
    more than ``task_rows`` rows, whether fitted or not, are set apart; there are at most cells / task_rows of them.
    """
    sizes = value_sizes(table) if sizes is None else sizes
    small = [c for c in keys if sizes.get(c, 0) <= inline]
    rest = sorted((c for c in keys if c not in small), key=lambda c: sizes[c])
    spent, shared, large = 0, [], []
    for c in rest:
        spent += sizes[c]
        (shared if spent <= budget else large).append(c)
    # At most ``inline`` rows of each small column, and one row of the others, for null.
    listed = table.where(F.col("column").isin(small) | F.col("value").isNull()).select("column", "value", payload).collect()
    key = {c: f"_key_{i}" for i, c in enumerate(keys)}
    result = df.withColumns({key[c]: v.cast("string") for c, v in keys.items()})
    kind = table.schema[payload].dataType.simpleString()
    found: dict[str, str] = {}
    for c in small:
        pairs = [f"{quoted(r['value'])}, {_literal(r[payload])}" for r in listed if r["column"] == c and r["value"] is not None]
        found[c] = f"try_element_at(map({', '.join(pairs)}), {key[c]})" if pairs else "NULL"
    for i, c in enumerate(shared):
        side = table.where(F.col("column") == c).select(F.col("value").alias(f"_value_{i}"), F.col(payload).alias(f"_shared_{i}"))
        result = result.join(F.broadcast(side), F.col(key[c]) == F.col(f"_value_{i}"), "left")
        found[c] = f"_shared_{i}"
    if large:
        result = _stacked(result, {c: key[c] for c in large}, table, payload, task_rows)
        found |= {c: f"_stacked{key[c]}" for c in large}
    nulls = {r["column"]: r[payload] for r in listed if r["value"] is None and r[payload] is not None}
    columns = []
    for c in keys:
        of_null = _literal(nulls[c]) if c in nulls else "NULL"
        columns.append(F.expr(f"CAST(CASE WHEN {key[c]} IS NULL THEN {of_null} ELSE {found[c]} END AS {kind})").alias(f"{prefix}{c}"))
    return result.select(*[F.col(f"`{c}`") for c in df.columns], *columns)


def _stacked(df: DataFrame, keys: dict[str, str], table: DataFrame, payload: str, task_rows: int) -> DataFrame:
    """``_stacked<key>`` beside the rows; ``keys``: column of the table -> key column of ``df``."""
    # Written, so that the row numbers are the same for the cells and for the rows.
    rows = written(df.withColumn("_row", F.monotonically_increasing_id()), "lookup-rows")
    named = [F.col(k).alias(c) for c, k in keys.items()]
    cells = rows.select("_row", *named).unpivot(["_row"], list(keys), "column", "value").where(F.col("value").isNotNull())
    fitted = table.select("column", "value", F.col(payload).alias("_payload"))
    heavy = _heavy(cells, fitted, task_rows)
    same = ["column", "value"]
    light = cells.join(F.broadcast(heavy), same, "left_anti").join(fitted, same)
    found = cells.join(F.broadcast(heavy), same).unionByName(light).where(F.col("_payload").isNotNull())
    per_row = found.groupBy("_row").agg(
        *[F.max(F.when(F.col("column") == c, F.col("_payload"))).alias(f"_stacked{k}") for c, k in keys.items()]
    )
    return rows.join(per_row, "_row", "left").drop("_row")


def _heavy(cells: DataFrame, fitted: DataFrame, task_rows: int) -> DataFrame:
    """(column, value, payload) of the texts on more than ``task_rows`` rows.

    Counted by hash first, which shuffles next to nothing; only texts in a bucket with that many rows are counted one by one.
    """
    hashed = cells.withColumn("_bucket", F.pmod(F.xxhash64("column", "value"), F.lit(BUCKETS)))
    many = F.col("_n") > task_rows
    suspects = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).where(many).select("_bucket")
    suspects = written(suspects, "lookup-buckets")
    counted = hashed.join(F.broadcast(suspects), "_bucket", "left_semi").groupBy("column", "value")
    heavy = counted.agg(F.count(F.lit(1)).alias("_n")).where(many).select("column", "value")
    return written(heavy.join(fitted, ["column", "value"], "left"), "lookup-heavy")
