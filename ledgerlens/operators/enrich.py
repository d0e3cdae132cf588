"""Row-preserving joins and lookups against fitted tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.guards import ID_COLUMN, TARGET_COLUMN, SchemaError, require_columns
from ledgerlens.session import TASK_ROWS


def enrich_identity(
    transactions: DataFrame, identity: DataFrame, key: str = ID_COLUMN, target: str | None = TARGET_COLUMN
) -> DataFrame:
    """All transactions, with the identity columns where there are any.

    ``target`` names the label that must be on the transaction side only; None
    for unlabelled batches.
    """
    require_columns(transactions, [key], "transactions")
    require_columns(identity, [key], "identity")
    if target is not None:
        require_columns(transactions, [target], "transactions")
        if target in identity.columns:
            raise SchemaError(f"The identity table must not hold the label {target}")
    return transactions.join(identity, key, "left")


def duplicate_keys(df: DataFrame, key: str = ID_COLUMN) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def build_curated(foundation: DataFrame, behavioral: DataFrame, key: str = ID_COLUMN) -> DataFrame:
    """Foundation columns win; the other table adds what is new. Keys must be unique on both sides."""
    require_columns(foundation, [key], "foundation")
    require_columns(behavioral, [key], "behavioral")
    for name, table in (("foundation", foundation), ("behavioral", behavioral)):
        repeated = duplicate_keys(table, key).first()
        if repeated is not None:
            raise SchemaError(f"Merge is not one-to-one: {key}={repeated[0]} repeats in {name}")
    new_columns = [c for c in behavioral.columns if c not in foundation.columns]
    return foundation.join(behavioral.select(key, *new_columns), key, "left")


def lookup_map(
    df: DataFrame,
    key: Column,
    table: DataFrame,
    table_key: str,
    values: dict[str, tuple[str, Column | None]],
    *,
    rows: str | None = None,
    null_keys: bool = True,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Attach fitted values by key; null keys match null keys.

    With ``null_keys=False`` no key is null: plain equality then lets a bucketed ``table`` (``files.bucketed``) be joined
    where it lies.

    ``values`` maps the output name to (column of ``table``, value when unseen).
    The planner broadcasts a table whose size is known to be small. With
    ``rows``, the column of ``table`` that counts each key's rows, a large table
    cannot be skewed either: keys of more than ``task_rows`` rows (at most total
    rows / task_rows of them) are looked up by broadcast, and their rows pass
    through the shuffled lookup of the others under spread stand-in keys.
    """
    inner = {name: f"_lookup_{i}" for i, name in enumerate(values)}

    def same(left: str, right: str) -> Column:
        return F.col(left).eqNullSafe(F.col(right)) if null_keys else F.col(left) == F.col(right)

    def side(part: DataFrame, prefix: str) -> DataFrame:
        return part.select(
            F.col(table_key).alias(f"{prefix}key"),
            F.lit(True).alias(f"{prefix}found"),
            *[F.col(values[n][0]).alias(f"{prefix}{inner[n]}") for n in values],
        )

    if rows is None:
        keyed = df.withColumn("_key", key)
        joined = keyed.join(side(table, "_l"), same("_key", "_lkey"), "left")
        found = {n: F.col(f"_l{inner[n]}") for n in values}
    else:
        spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(4096)))
        keyed = df.withColumn("_key", key.cast("string"))
        heavy = side(table.where(F.col(rows) > task_rows), "_h")
        light = side(table.where(F.col(rows) <= task_rows), "_l")
        marked = keyed.join(F.broadcast(heavy), same("_key", "_hkey"), "left")
        marked = marked.withColumn("_key", F.when(F.col("_hfound"), spread).otherwise(F.col("_key")))
        joined = marked.join(light, same("_key", "_lkey"), "left")
        found = {n: F.coalesce(F.col(f"_h{inner[n]}"), F.col(f"_l{inner[n]}")) for n in values}
    filled = {n: c if values[n][1] is None else F.coalesce(c, values[n][1]) for n, c in found.items()}
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in filled], *[c.alias(n) for n, c in filled.items()]
    )


def known_category_filter(
    df: DataFrame, key: Column, vocabulary: DataFrame, vocabulary_key: str, seen: bool = True
) -> DataFrame:
    """Rows whose key is (or, with ``seen=False``, is not) in the fitted vocabulary."""
    right = vocabulary.select(F.col(vocabulary_key).alias("_known_key")).distinct()
    condition = F.col("_key").eqNullSafe(F.col("_known_key"))
    return df.withColumn("_key", key).join(right, condition, "left_semi" if seen else "left_anti").drop("_key")


def identity_coverage(transactions: DataFrame, identity: DataFrame, key: str = ID_COLUMN) -> DataFrame:
    """Matched and unmatched transaction counts, whether rows were kept, columns added: one row."""
    copies = identity.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    added = len([c for c in identity.columns if c != key])
    flagged = transactions.select(key).join(copies, key, "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count("_copies").alias("matched"),
        F.count_if(F.col("_copies").isNull()).alias("unmatched"),
        F.lit(added).cast("bigint").alias("columns_added"),
        (F.max(F.coalesce("_copies", F.lit(1))) == 1).alias("rows_preserved"),
    )
