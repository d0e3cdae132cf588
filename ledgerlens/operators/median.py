"""Exact median of an entity's earlier amounts, at any entity size.

A running median cannot be merged from partial results like a mean, so large
entities are cut into segments of time. The median can move by at most one
place per added row: inside a segment of m rows it stays within m places of
the median of everything before. Each segment therefore needs its own rows and
the middle m or so values of its past, which are found by counting in value
bins. All pieces are of about the square root of the entity's rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import uid
from ledgerlens.operators.ordered import running_totals
from ledgerlens.session import written

SMALL_ENTITY = 50_000  # amounts of one entity that one task sorts as they come
SPREAD = 64  # parts of a bin that many segments ask for
RESULT = "_key string, _t bigint, median double"


def _running(times, values, weights, seen: list, below: int, total: int) -> list[tuple]:
    """(time, median so far) for each new time; rows are in time order.

    ``seen`` holds the sorted values around the median, ``below`` values lie
    under them and ``total`` values came before.
    """
    found, current = [], None
    for t, x, w in zip(times, values, weights):
        if t != current:
            current = t
            middle = (seen[(total - 1) // 2 - below] + seen[total // 2 - below]) / 2 if total else None
            found.append((t, middle))
        at = bisect_right(seen, x)
        seen[at:at] = [x] * int(w)
        total += int(w)
    return found


def _small_entities(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (entity, time), an entity possibly spread over several frames."""
    held: pd.DataFrame | None = None
    for frame in frames:
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        if frame.empty:
            continue
        last = frame["_key"] == frame["_key"].iloc[-1]
        held = frame[last]
        yield _each_entity(frame[~last])
    if held is not None:
        yield _each_entity(held)


def _each_entity(frame: pd.DataFrame) -> pd.DataFrame:
    rows = [
        (key, t, m)
        for key, part in frame.groupby("_key", sort=False)
        for t, m in _running(part["_t"], part["x"], part["w"], [], 0, 0)
    ]
    return pd.DataFrame(rows, columns=["_key", "_t", "median"]).astype({"median": "float64"})


def _segment(frame: pd.DataFrame) -> pd.DataFrame:
    """One segment: its own rows (kind 1) and the middle values of its past (kind 0).

    Of the past only the ranks within reach of the median are laid out, so a
    value that repeats a million times costs no more than the segment's size.
    """
    past = frame[frame["kind"] == 0].sort_values("x")
    own = frame[frame["kind"] == 1].sort_values("_t")
    first = own.iloc[0]
    total, piece = int(first["total"]), int(first["piece"])
    down, up = _reach(total, piece)
    start = int(first["below"]) + past["w"].cumsum() - past["w"]
    copies = ((start + past["w"]).clip(upper=up + 1) - start.clip(lower=down)).clip(lower=0)
    seen = past["x"].repeat(copies).tolist()
    rows = _running(own["_t"], own["x"], own["w"], seen, max(int(first["below"]), down), total)
    table = pd.DataFrame(rows, columns=["_t", "median"]).astype({"median": "float64"})
    table.insert(0, "_key", first["_key"])
    return table


def _reach(total, piece):
    """The ranks of the past that a median can touch while fewer than ``piece`` rows are added."""
    return (total - piece) // 2 - 2, (total + piece) // 2 + 2


def _large_entities(points: DataFrame, sizes: DataFrame) -> DataFrame:
    """Medians for the entities in ``sizes`` (_key, size, piece); ``points`` are their (_key, _t, x, w)."""
    points = written(points.join(F.broadcast(sizes), "_key"), "median-points")

    def pieces(value: str, name: str) -> DataFrame:
        counts = points.groupBy("_key", "piece", value).agg(F.sum("w").alias("n"))
        upto = running_totals(counts, ["_key"], value, ["n"])
        number = F.floor((F.col("n_upto") - F.col("n")) / F.col("piece")).cast("int")
        return upto.select("_key", value, number.alias(name))

    placed = points.join(pieces("_t", "segment"), ["_key", "_t"]).join(pieces("x", "bin"), ["_key", "x"])
    placed = written(placed, "median-placed")
    cells = placed.groupBy("_key", "segment", "bin").agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("points"))

    # Every (segment, bin) of an entity: as many cells as it has rows, at most.
    last = F.floor(F.col("size") / F.col("piece")).cast("int")
    grid = sizes.select("_key", "piece", F.explode(F.sequence(F.lit(0), last)).alias("segment"), last.alias("last"))
    grid = grid.repartition("_key", "segment")  # else one task lays out all cells of an entity
    grid = grid.select("_key", "piece", "segment", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("bin"))
    dense = grid.join(cells, ["_key", "segment", "bin"], "left").fillna(0, ["n", "points"])
    earlier = Window.partitionBy("_key", "bin").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    lower = Window.partitionBy("_key", "segment").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_key", "segment")
    past = (
        dense.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .withColumn("start", F.coalesce(F.sum("before").over(lower), F.lit(0)))
        .withColumns({"total": F.sum("before").over(whole), "points": F.sum("points").over(whole)})
    )
    reach_down = F.floor((F.col("total") - F.col("piece")) / 2) - 2
    reach_up = F.floor((F.col("total") + F.col("piece")) / 2) + 2
    near = (F.col("before") > 0) & (F.col("start") <= reach_up) & (F.col("start") + F.col("before") > reach_down)
    wanted = written(
        past.where(near & (F.col("points") > 0)).select("_key", "segment", "bin", "start", "total"), "median-wanted"
    )
    offsets = wanted.groupBy("_key", "segment").agg(F.min("start").alias("below"), F.max("total").alias("total"))

    # While the median is stable all segments ask for one bin: its values are spread, the requests repeated.
    requests = wanted.select("_key", "bin", "segment", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("x", "segment"), F.lit(SPREAD)).cast("int")
    middle = (
        placed.where(F.col("w") > 0)
        .select("_key", "bin", salt.alias("salt"), F.col("segment").alias("from_segment"), "x", "w")
        .join(requests, ["_key", "bin", "salt"])
        .where(F.col("from_segment") < F.col("segment"))
        .groupBy("_key", "segment", "x")
        .agg(F.sum("w").alias("w"))
    )
    # A segment's last second needs its past but adds nothing within the segment. Being cut by
    # starting rank, the seconds before it hold fewer than ``piece`` rows, however large it is itself.
    ends = placed.groupBy("_key", "segment").agg(F.max("_t").alias("end"), F.max("piece").alias("piece"))
    inner = placed.drop("piece").join(ends, ["_key", "segment"]).where(F.col("_t") < F.col("end")).drop("end")
    closing = ends.withColumnRenamed("end", "_t").withColumns({"x": F.lit(0.0), "w": F.lit(0).cast("bigint")})
    names = ["_key", "segment", "_t", "x", "w", "piece"]
    own = inner.select(*names).unionByName(closing.select(*names))
    own = own.join(offsets, ["_key", "segment"], "left").fillna(0, ["below", "total"])
    columns = ["_key", "segment", "kind", "_t", "x", "w", "below", "total", "piece"]
    own = own.withColumn("kind", F.lit(1)).select(*columns)
    none = {c: F.lit(0).cast("bigint") for c in ("_t", "below", "total", "piece")}
    middle = middle.withColumns({"kind": F.lit(0), **none}).select(*columns)
    return own.unionByName(middle).groupBy("_key", "segment").applyInPandas(_segment, RESULT)


def past_medians(points: DataFrame, *, small_entity: int = SMALL_ENTITY) -> DataFrame:
    """(_key, _t, median) over strictly earlier times, from (_key, _t, x, w) with w equal amounts x."""
    per_key = written(points.groupBy("_key").agg(F.sum("w").alias("size")), "median-sizes")
    # At most total rows / small_entity keys are large.
    large = per_key.where(F.col("size") > small_entity)
    piece = F.greatest(F.lit(small_entity), F.ceil(F.sqrt("size"))).cast("bigint")
    small = points if large.isEmpty() else points.join(F.broadcast(large.select("_key")), "_key", "left_anti")
    ordered = small.select("_key", "_t", "x", "w").repartition("_key").sortWithinPartitions("_key", "_t")
    medians = ordered.mapInPandas(_small_entities, RESULT)
    if large.isEmpty():
        return medians
    heavy = points.join(F.broadcast(large.select("_key")), "_key", "left_semi")
    return medians.unionByName(_large_entities(heavy, large.withColumn("piece", piece)))


def past_history_median(
    df: DataFrame,
    key: Column | None = None,
    amount: str = "TransactionAmt",
    time: str = "TransactionDT",
    name: str = "uid_past_median",
    *,
    small_entity: int = SMALL_ENTITY,
) -> DataFrame:
    """Add the median of the entity's amounts in strictly earlier seconds (null when there are none)."""
    key = uid() if key is None else key
    keyed = df.withColumn("_key", key)
    points = keyed.groupBy("_key", F.col(time).alias("_t"), F.col(amount).alias("x")).agg(
        F.count(F.lit(1)).alias("w")
    )
    # A second without a known amount still has a past: it takes part with no weight.
    points = points.select(
        "_key",
        "_t",
        F.coalesce(F.col("x"), F.lit(0.0)).alias("x"),
        F.when(F.col("x").isNull(), F.lit(0)).otherwise(F.col("w")).cast("bigint").alias("w"),
    )
    medians = past_medians(written(points, "median-input"), small_entity=small_entity)
    medians = medians.select(F.col("_key").alias("_k"), "_t", F.col("median").alias(name))
    same = (F.col("_key") == F.col("_k")) & F.col(time).eqNullSafe(F.col("_t"))
    return keyed.join(medians, same, "left").select(*df.columns, name)
