"""Entity timelines: gaps, past-only history and rolling sums.

Rows collapse to one per (entity, second) before anything is ordered, and the
seconds are worked through in fixed slices of the calendar. A task therefore
holds at most one slice of one entity (SLICE_SECONDS rows), however many
transactions an entity has; what came before a slice arrives as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import DAY_SECONDS, STD_EPSILON, uid

SLICE_SECONDS = 30 * DAY_SECONDS
NO_KEY = "\u0000"  # stands for a null key
NO_TIME = -(1 << 60)  # stands for a null time


def _slice(time: str, seconds: int) -> Column:
    return F.floor(F.col(time) / seconds).cast("bigint")


def uid_time_gaps(
    df: DataFrame,
    key: Column | None = None,
    time: str = "TransactionDT",
    row_id: str = "TransactionID",
    *,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Previous and next time of the same entity, order (time, id).

    Within one second only the first row looks back to an earlier second and
    only the last looks ahead; the others are neighbours at distance zero.
    ``uid_next_dt`` / ``uid_time_to_next`` look into the future: analysis only.
    """
    keyed = df.withColumn("uid", uid() if key is None else key)
    seconds = (
        keyed.groupBy("uid", F.col(time).alias("_t"))
        .agg(F.min(row_id).alias("_first"), F.max(row_id).alias("_last"))
        .withColumn("_slice", _slice("_t", slice_seconds))
    )
    edges = seconds.groupBy("uid", "_slice").agg(F.max("_t").alias("_end"), F.min("_t").alias("_start"))
    by_slice = Window.partitionBy("uid").orderBy("_slice")
    edges = edges.select(
        "uid",
        "_slice",
        F.lag("_end").over(by_slice).alias("_before"),
        F.lead("_start").over(by_slice).alias("_after"),
    )
    inside = Window.partitionBy("uid", "_slice").orderBy("_t")
    near = seconds.select(
        "*", F.lag("_t").over(inside).alias("_near_before"), F.lead("_t").over(inside).alias("_near_after")
    )
    neighbours = near.join(edges, ["uid", "_slice"], "left").select(
        F.col("uid").alias("_uid"),
        "_t",
        "_first",
        "_last",
        F.coalesce("_near_before", "_before").alias("_previous"),
        F.coalesce("_near_after", "_after").alias("_next"),
    )
    same = F.col("uid").eqNullSafe(F.col("_uid")) & F.col(time).eqNullSafe(F.col("_t"))
    joined = keyed.join(neighbours, same, "left")
    previous = F.when(F.col(row_id) == F.col("_first"), F.col("_previous")).otherwise(F.col(time))
    following = F.when(F.col(row_id) == F.col("_last"), F.col("_next")).otherwise(F.col(time))
    return joined.withColumns({"uid_prev_dt": previous, "uid_next_dt": following}).select(
        *keyed.columns,
        "uid_prev_dt",
        "uid_next_dt",
        (F.col(time) - F.col("uid_prev_dt")).alias("uid_time_from_prev"),
        (F.col("uid_next_dt") - F.col(time)).alias("uid_time_to_next"),
    )


def time_since_previous(
    df: DataFrame, key: Column | None = None, time: str = "TransactionDT", row_id: str = "TransactionID"
) -> DataFrame:
    """The past-only half of the gaps, safe as a feature."""
    gaps = uid_time_gaps(df, key, time, row_id)
    return gaps.select(
        *[c for c in df.columns],
        F.col("uid_time_from_prev").alias("time_since_previous_uid_transaction"),
    )


def merged(n1: Column, m1: Column, s1: Column, n2: Column, m2: Column, s2: Column) -> tuple[Column, Column, Column]:
    """Count, mean and squared deviations of two disjoint parts taken together."""
    n = n1 + n2
    safe = F.when(n == 0, F.lit(1)).otherwise(n).cast("double")
    gap = m2 - m1
    return n, m1 + gap * n2 / safe, s1 + s2 + gap * gap * n1 * n2 / safe


def _text_key(column: str) -> Column:
    """Entity text for one column; null is an entity of its own, as in the uid."""
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def history_keys() -> dict[str, Column]:
    return {"uid": uid(), "card1": _text_key("card1"), "addr1": _text_key("addr1")}


def second_totals(df: DataFrame, key: Column, time: str, amount: str) -> DataFrame:
    """(entity, second): rows, known amounts, mean, squared deviations, min, max."""
    return (
        df.select(key.alias("_key"), F.col(time).alias("_t"), F.col(amount).alias("_x"))
        .groupBy("_key", "_t")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("_x").alias("n"),
            F.coalesce(F.avg("_x"), F.lit(0.0)).alias("mean"),
            (F.coalesce(F.var_pop("_x"), F.lit(0.0)) * F.count("_x")).alias("m2"),
            F.min("_x").alias("low"),
            F.max("_x").alias("high"),
        )
    )


def _before(df: DataFrame, partition: list[str], order: str, prefix: str) -> DataFrame:
    """Totals of all earlier rows of the partition (rows, n, mean, m2, low, high, last time).

    Sums are centred on the partition's own mean, so the variance keeps its digits.
    """
    whole = Window.partitionBy(*partition)
    past = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    all_n = F.sum("n").over(whole)
    centre = F.sum(F.col("n") * F.col("mean")).over(whole) / F.when(all_n == 0, F.lit(1)).otherwise(all_n)
    centred = df.withColumn("_centre", centre).withColumns(
        {
            "_s1": F.col("n") * (F.col("mean") - F.col("_centre")),
            "_s2": F.col("m2") + F.col("n") * (F.col("mean") - F.col("_centre")) * (F.col("mean") - F.col("_centre")),
        }
    )
    summed = centred.withColumns(
        {
            f"{prefix}rows": F.coalesce(F.sum("rows").over(past), F.lit(0)),
            f"{prefix}n": F.coalesce(F.sum("n").over(past), F.lit(0)),
            "_p1": F.coalesce(F.sum("_s1").over(past), F.lit(0.0)),
            "_p2": F.coalesce(F.sum("_s2").over(past), F.lit(0.0)),
            f"{prefix}low": F.min("low").over(past),
            f"{prefix}high": F.max("high").over(past),
            f"{prefix}last": F.max("_last_t").over(past),
        }
    )
    n = F.when(F.col(f"{prefix}n") == 0, F.lit(1)).otherwise(F.col(f"{prefix}n"))
    return summed.withColumns(
        {
            f"{prefix}mean": F.col("_centre") + F.col("_p1") / n,
            f"{prefix}m2": F.greatest(F.col("_p2") - F.col("_p1") * F.col("_p1") / n, F.lit(0.0)),
        }
    ).drop("_centre", "_s1", "_s2", "_p1", "_p2")


def past_totals(seconds: DataFrame, *, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """For each (entity, second): totals over strictly earlier seconds of the entity.

    Output: _key, _t, past_rows, past_n, past_mean, past_m2, past_low, past_high, past_last.
    """
    sliced = seconds.withColumns({"_slice": _slice("_t", slice_seconds), "_last_t": F.col("_t")})
    inside = _before(sliced, ["_key", "_slice"], "_t", "a_")
    # The last second of a slice together with what preceded it is the whole slice.
    per_slice = (
        inside.groupBy("_key", "_slice")
        .agg(
            F.max_by(
                F.struct("a_rows", "a_n", "a_mean", "a_m2", "rows", "n", "mean", "m2"), "_t"
            ).alias("_end"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.max("_t").alias("_last_t"),
        )
    )
    end = F.col("_end")
    n, mean, m2 = merged(end["a_n"], end["a_mean"], end["a_m2"], end["n"], end["mean"], end["m2"])
    per_slice = per_slice.select(
        "_key",
        "_slice",
        (end["a_rows"] + end["rows"]).alias("rows"),
        n.alias("n"),
        mean.alias("mean"),
        m2.alias("m2"),
        "low",
        "high",
        "_last_t",
    )
    carried = _before(per_slice, ["_key"], "_slice", "b_").select(
        "_key", "_slice", *[f"b_{c}" for c in ("rows", "n", "mean", "m2", "low", "high", "last")]
    )
    both = inside.join(carried, ["_key", "_slice"], "left")
    n, mean, m2 = merged(*[F.col(f"b_{c}") for c in ("n", "mean", "m2")], *[F.col(f"a_{c}") for c in ("n", "mean", "m2")])
    return both.select(
        "_key",
        "_t",
        (F.col("a_rows") + F.col("b_rows")).alias("past_rows"),
        n.alias("past_n"),
        mean.alias("past_mean"),
        m2.alias("past_m2"),
        F.least("a_low", "b_low").alias("past_low"),
        F.greatest("a_high", "b_high").alias("past_high"),
        F.coalesce("a_last", "b_last").alias("past_last"),
    )


def history_columns(amount: Column, prefix: str, past: Column) -> dict[str, Column]:
    """Feature columns from a row's past totals (a struct); null where there is no past amount."""
    n = past["n"]
    mean = F.when(n > 0, past["mean"])
    std = F.when(n > 1, F.sqrt(past["m2"] / (n - 1)))
    return {
        f"{prefix}_past_count": F.coalesce(past["rows"], F.lit(0)),
        f"{prefix}_past_mean": mean,
        f"{prefix}_past_std": std,
        f"{prefix}_past_min": past["low"],
        f"{prefix}_past_max": past["high"],
        f"{prefix}_past_deviation": (amount - mean) / (F.coalesce(std, F.lit(0.0)) + F.lit(STD_EPSILON)),
    }


def past_history_features(
    df: DataFrame,
    keys: dict[str, Column] | None = None,
    amount: str = "TransactionAmt",
    time: str = "TransactionDT",
    *,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Count, mean, std, min, max and deviation of amounts of strictly earlier seconds, per key.

    All keys are worked through together, as (key kind and key, second) rows; the table itself is shuffled once, to meet
    what was found for its combination of keys and second. Null keys are one entity, null times one second before all others.
    """
    keys = keys or history_keys()
    kinds = list(keys)
    named = {f"_key_{i}": F.coalesce(keys[k].cast("string"), F.lit(NO_KEY)) for i, k in enumerate(kinds)}
    at = F.coalesce(F.col(time), F.lit(NO_TIME)).alias("_t")
    # Everything below but the last join moves these narrow rows only.
    narrow = df.select(*[c.alias(n) for n, c in named.items()], at, F.col(amount).alias("_x"))
    entities = F.array(*[F.concat(F.lit(f"{i}:"), F.col(n)) for i, n in enumerate(named)])
    seconds = second_totals(narrow.withColumn("_entity", F.explode(entities)), F.col("_entity"), "_t", "_x")
    past = past_totals(seconds, slice_seconds=slice_seconds)
    measures = ["rows", "n", "mean", "m2", "low", "high"]
    past = past.select("_key", "_t", F.struct(*[F.col(f"past_{m}").alias(m) for m in measures]).alias("_past"))
    # One row for each combination of keys in a second collects the pasts of its entities.
    together = [*named, "_t"]
    wanted = narrow.select(*together).distinct().select("*", F.posexplode(entities).alias("_kind", "_key"))
    per_kind = [F.max(F.when(F.col("_kind") == i, F.col("_past"))).alias(f"_past_{i}") for i in range(len(kinds))]
    found = wanted.join(past, ["_key", "_t"], "left").groupBy(*together).agg(*per_kind)
    joined = df.withColumns({**named, "_t": at}).join(found, together, "left")
    features = [
        column.alias(name)
        for i, prefix in enumerate(kinds)
        for name, column in history_columns(F.col(amount), prefix, F.col(f"_past_{i}")).items()
    ]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *features)


def rolling_history(
    df: DataFrame,
    seconds: int,
    key: Column | None = None,
    amount: str = "TransactionAmt",
    time: str = "TransactionDT",
    prefix: str = "uid",
) -> DataFrame:
    """Count and sum of the entity's amounts in the ``seconds`` before the row's second.

    Each (entity, second) also visits the next slice, so a slice of length
    ``seconds`` and the one before it hold every frame; at most three times
    ``seconds`` rows meet in a task. One running total serves all frames: its
    value before the second less its value where the frame begins, which a
    probe row marks, so the work is linear in the rows.
    """
    key = uid() if key is None else key
    totals = (
        df.select(key.alias("_key"), F.col(time).alias("_t"), F.col(amount).alias("_x"))
        .groupBy("_key", "_t")
        .agg(F.count(F.lit(1)).alias("rows"), F.count("_x").alias("n"), F.coalesce(F.sum("_x"), F.lit(0.0)).alias("total"))
        .where("_t IS NOT NULL")
        .withColumn("_home", _slice("_t", seconds))
    )
    sums = ["rows", "n", "total"]

    def places(at: Column, shift: int, *values: Column) -> Column:
        """One row of a slice: where it stands, whether it is a row, a probe (0) or a visitor (2), and its sums."""
        named = [v.alias(c) for v, c in zip(values, sums)]
        kind = F.lit(0) if at is not whole else F.lit(1 if shift == 0 else 2)
        return F.struct((F.col("_home") + shift).alias("_slice"), at.alias("_at"), kind.alias("_kind"), *named)

    whole, begin = F.col("_t"), F.col("_t") - seconds
    own = [F.col(c) for c in sums]
    none = [F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.lit(0.0)]
    visits = totals.select(
        "_key", "_t", F.explode(F.array(places(whole, 0, *own), places(whole, 1, *own), places(begin, 0, *none))).alias("_p")
    ).select("_key", "_t", "_p.*")
    # At one second the probe comes first: the frame's first second is inside.
    before = Window.partitionBy("_key", "_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    summed = visits.withColumns({f"_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in sums})

    def frame(c: str) -> Column:
        return F.max(F.when(F.col("_kind") == 1, F.col(f"_{c}"))) - F.max(F.when(F.col("_kind") == 0, F.col(f"_{c}")))

    framed = summed.where("_kind < 2").groupBy("_key", "_slice", "_t").agg(*[frame(c).alias(f"_{c}") for c in sums])
    rolled = framed.select("_key", "_t", "_rows", F.when(F.col("_n") > 0, F.col("_total")).alias("_total"))
    same = F.col("_join_key").eqNullSafe(F.col("_key")) & F.col(time).eqNullSafe(F.col("_t"))
    return (
        df.withColumn("_join_key", key)
        .join(rolled, same, "left")
        .select(
            *df.columns,
            F.coalesce("_rows", F.lit(0)).alias(f"{prefix}_count_{seconds}s"),
            F.col("_total").alias(f"{prefix}_sum_{seconds}s"),
        )
    )
