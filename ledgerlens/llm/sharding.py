"""Shards that all hold the mixture of the sources: proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked. Row r of a source with n rows stands at the
fraction (r + u) / n, u being the source's own seeded offset in [0, 1), so that sources of one row each do not all
stand in the middle. Sorted by fraction, any stretch of rows holds each source in its share; the sequence is cut into
shards whose row counts differ by one at most. Of a source with n rows, a shard that spans the fractions from a to b
holds n * (b - a) rows, give or take one.

Both orders, (source, hash) and fraction, are ranked by ranges (``ranks.positions``), so a source with a third of all
rows is spread over many tasks. Texts stay where they are: only ids, sizes and hashes move.

Defined cases: a null source is a source of its own; null and empty texts count 8 bytes and have the checksum 0; repeated
rows, and rows without doc_id, each get a place; with fewer rows than shards, some shards are empty; an empty table gives
no rows. Extra columns don't matter to ``interleaved`` and pass through ``sharded``, whatever they are called; there
output columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.ranks import positions
from ledgerlens.session import written

ROW_BYTES = 8  # of a row besides its text


def _hash(seed: int, value: Column, digits: int) -> Column:
    """The first hex digits of sha256("seed:value") as an integer; null counts as no text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, digits), 16, 10).cast("bigint")


def stratum_name(source: Column) -> Column:
    """A source as text that sorts and joins; null is one source, apart from the empty name."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def interleaved(
    docs: DataFrame,
    shards: int,
    seed: int = 11,
    source: str = "source",
    text: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (place in the shard, from 0), one row per row of ``docs``.

    ``carry``: columns of ``docs`` that come along, which then move twice.
    """
    carry = carry or []
    raw = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    slim = written(
        docs.select(
            "doc_id",
            (F.octet_length(raw) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(raw.cast("binary")).alias("text_crc32"),
            stratum_name(F.col(f"`{source}`")).alias("_stratum"),
            _hash(seed, F.col("doc_id"), 15).alias("_h"),
            F.monotonically_increasing_id().alias("_row"),
            F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], F.lit(0)).alias("_carried"),
        ),
        "shard-rows",
    )
    total = slim.count()
    ranked = positions(slim, [F.col(c) for c in ("_stratum", "_h", "doc_id", "_row")], "_at")
    ranked = written(ranked, "shard-ranks")
    strata = ranked.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    strata = written(strata, "shard-strata").withColumn("_u", _hash(seed, F.col("_stratum"), 8) / F.lit(4294967296.0))
    fraction = (F.col("_at") - F.col("_first") + F.col("_u")) / F.col("_n")
    rows = ranked.join(strata, "_stratum").withColumn("_fraction", fraction).drop("_n", "_first", "_u")
    rows = written(rows, "shard-fractions")
    rows = positions(rows, [F.col("_fraction"), F.col("_at")], "_position")
    # Shard k holds the places from floor(k * total / shards) on.
    shard = F.expr(f"((_position + 1) * {shards} - 1) DIV {max(total, 1)}").cast("int")
    rows = rows.withColumn("_shard", shard)
    start = F.expr(f"(CAST(_shard AS bigint) * {total}) DIV {shards}")
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("_shard").alias("shard"),
        (F.col("_position") - start).alias("slot"),
        *[F.col("_carried")[f"c{i}"].alias(c) for i, c in enumerate(carry)],
    )


def sharded(docs: DataFrame, path: str, shards: int, seed: int = 11, source: str = "source", text: str = "text") -> DataFrame:
    """Write ``docs`` below ``path``, a folder per shard, and return the rows with shard and slot.

    The files of a shard are each sorted by slot, and hold stretches of slots that don't overlap.
    """
    names = {"size", "text_crc32", "shard", "slot", "doc_id"}
    carry = [c for c in docs.columns if c not in names]
    rows = interleaved(docs, shards, seed, source, text, carry)
    files = max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = written(rows, "sharded").repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot")
    placed.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)
