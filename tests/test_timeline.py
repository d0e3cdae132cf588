"""Timelines: slices of the calendar must not show in the results."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import median, timeline
from ledgerlens.session import written


@pytest.fixture
def frame():
    rng = np.random.default_rng(3)
    n = 800
    hot = rng.random(n) < 0.4
    return pd.DataFrame(
        {
            "TransactionID": np.arange(n),
            "TransactionDT": np.where(rng.random(n) < 0.2, 500, rng.integers(0, 3000, n)),
            "TransactionAmt": np.where(rng.random(n) < 0.1, np.nan, np.round(rng.exponential(30, n), 2)),
            "card1": np.where(hot, 1, rng.integers(2, 30, n)),
            "addr1": rng.integers(1, 3, n),
        }
    )


def _spark(spark, frame):
    clean = frame.astype(object).where(frame.notna(), None)
    schema = "TransactionID bigint, TransactionDT bigint, TransactionAmt double, card1 bigint, addr1 bigint"
    return spark.createDataFrame(clean, schema)


@pytest.mark.parametrize("slice_seconds", [10**7, 100])
def test_gaps_equal_shift(spark, frame, slice_seconds):
    found = timeline.uid_time_gaps(_spark(spark, frame), slice_seconds=slice_seconds).toPandas().set_index("TransactionID")
    ordered = frame.assign(uid=frame.card1.astype(str) + "_" + frame.addr1.astype(str)).sort_values(["TransactionDT", "TransactionID"])
    previous = ordered.groupby("uid")["TransactionDT"].shift(1)
    following = ordered.groupby("uid")["TransactionDT"].shift(-1)
    got = found.loc[ordered.TransactionID]
    assert np.array_equal(got.uid_prev_dt.to_numpy(float), previous.to_numpy(float), equal_nan=True)
    assert np.array_equal(got.uid_next_dt.to_numpy(float), following.to_numpy(float), equal_nan=True)


@pytest.mark.parametrize("slice_seconds", [10**7, 100])
def test_past_history_equals_brute_force(spark, frame, slice_seconds):
    found = timeline.past_history_features(_spark(spark, frame), slice_seconds=slice_seconds).toPandas().set_index("TransactionID")
    for row in frame.sample(80, random_state=1).itertuples():
        earlier = frame[(frame.card1 == row.card1) & (frame.addr1 == row.addr1) & (frame.TransactionDT < row.TransactionDT)]
        got = found.loc[row.TransactionID]
        assert got.uid_past_count == len(earlier)
        amounts = earlier.TransactionAmt.dropna()
        for name, value in (("mean", amounts.mean()), ("std", amounts.std()), ("min", amounts.min()), ("max", amounts.max())):
            assert np.isclose(float(got[f"uid_past_{name}"]), value, equal_nan=True, atol=1e-9)


def test_rolling_history_equals_brute_force(spark, frame):
    found = timeline.rolling_history(_spark(spark, frame), 60).toPandas().set_index("TransactionID")
    for row in frame.sample(80, random_state=2).itertuples():
        same = (frame.card1 == row.card1) & (frame.addr1 == row.addr1)
        inside = frame[same & (frame.TransactionDT < row.TransactionDT) & (frame.TransactionDT >= row.TransactionDT - 60)]
        assert found.loc[row.TransactionID].uid_count_60s == len(inside)
        total = inside.TransactionAmt.sum(min_count=1)
        assert np.isclose(float(found.loc[row.TransactionID].uid_sum_60s), total, equal_nan=True)


@pytest.mark.parametrize("small_entity", [50_000, 25, 5])
def test_past_median_equals_brute_force(spark, frame, small_entity):
    rows = _spark(spark, frame).withColumn("TransactionDT", F.expr("IF(TransactionID % 9 = 0, 777, TransactionDT)"))
    rows = rows.withColumn("TransactionAmt", F.expr("IF(TransactionID % 4 = 0, 12.5, TransactionAmt)"))
    found = median.past_history_median(rows, small_entity=small_entity).toPandas().set_index("TransactionID")
    frame = frame.assign(
        TransactionDT=np.where(frame.TransactionID % 9 == 0, 777, frame.TransactionDT),
        TransactionAmt=np.where(frame.TransactionID % 4 == 0, 12.5, frame.TransactionAmt),
    )
    assert len(found) == len(frame)
    for row in frame.itertuples():
        same = (frame.card1 == row.card1) & (frame.addr1 == row.addr1)
        earlier = frame[same & (frame.TransactionDT < row.TransactionDT)].TransactionAmt.median()
        assert np.isclose(float(found.loc[row.TransactionID].uid_past_median), earlier, equal_nan=True)


@pytest.mark.parametrize("seconds", [1, 40, 700, 10_000])
def test_rolling_sums(spark, frame, seconds):
    rolled = timeline.rolling_history(_spark(spark, frame), seconds).collect()
    assert len(rolled) == len(frame)
    for r in rolled[::3]:
        near = frame[(frame.card1 == r.card1) & (frame.addr1 == r.addr1)]
        near = near[(near.TransactionDT >= r.TransactionDT - seconds) & (near.TransactionDT < r.TransactionDT)]
        assert r[f"uid_count_{seconds}s"] == len(near)
        known = near.TransactionAmt.dropna()
        total = r[f"uid_sum_{seconds}s"]
        assert (total is None) if known.empty else total == pytest.approx(known.sum(), abs=1e-6)


def test_rolling_sums_of_one_long_entity(spark):
    """A day's frame over one row a second: linear, so this ends in seconds."""
    rows = spark.range(86_400).selectExpr("id AS TransactionID", "id AS TransactionDT", "1.0D AS TransactionAmt", "1L AS card1", "1L AS addr1")
    rolled = timeline.rolling_history(rows, 86_400)
    assert rolled.agg(F.max("uid_count_86400s"), F.sum("uid_sum_86400s")).first()[:] == (86_399, 86_399 * 86_400 / 2)


def test_past_history_shuffles_the_table_once(spark, frame):
    """Three keys: the wide column passes one exchange, and rows without a key or a time are kept."""
    wide = _spark(spark, frame).withColumn("wide", F.col("card1").cast("string"))
    odd = wide.limit(4).withColumns({"TransactionDT": F.lit(None).cast("bigint"), "card1": F.lit(None).cast("bigint")})
    rows = timeline.past_history_features(wide.unionByName(odd)).collect()
    assert len(rows) == len(frame) + 4
    assert all(r["uid_past_count"] == 0 for r in rows if r["TransactionDT"] is None)

    def listed(items):
        return [items.apply(i) for i in range(items.size())]

    def exchanges(node):
        """Exchanges that the wide column passes, in any branch of the plan."""
        if node.nodeName() == "AdaptiveSparkPlan":
            return exchanges(node.executedPlan())
        here = "Exchange" in node.nodeName() and "wide" in [a.name() for a in listed(node.output())]
        return here + sum(map(exchanges, listed(node.children())))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = timeline.past_history_features(written(wide, "wide"))._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert exchanges(plan) == 1
