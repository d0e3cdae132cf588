"""Range-split order statistics equal the one-task forms; tiny task_rows forces many ranges."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.operators import encoding, ordered
from ledgerlens.session import written


@pytest.fixture
def skewed(spark):
    """One key holds more than a third of the rows; many equal values."""
    rng = np.random.default_rng(7)
    n = 3000
    keys = np.where(rng.random(n) < 0.4, "hot", [f"k{i}" for i in rng.integers(0, 40, n)])
    values = np.where(rng.random(n) < 0.3, 5.0, np.round(rng.exponential(50, n), 2))
    return pd.DataFrame({"key": keys, "value": values})


@pytest.mark.parametrize("task_rows", [1_000_000, 97])
def test_group_quantiles(spark, skewed, task_rows):
    df = spark.createDataFrame(skewed)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = {r["key"]: r["quantiles"] for r in ordered.group_quantiles(df, ["key"], "value", probabilities, task_rows=task_rows).collect()}
    for key, part in skewed.groupby("key"):
        assert np.allclose(found[key], part["value"].quantile(probabilities))


@pytest.mark.parametrize("task_rows", [1_000_000, 50])
def test_column_quantiles_with_nulls(spark, skewed, task_rows):
    frame = skewed.assign(other=lambda d: d["value"].where(d["value"] != 5.0), none=None)
    df = spark.createDataFrame(frame[["value", "other"]].astype(object).where(frame[["value", "other"]].notna(), None), "value double, other double")
    df = df.selectExpr("value", "other", "CAST(NULL AS DOUBLE) AS none")
    found = {r["column"]: r["quantiles"] for r in ordered.column_quantiles(df, ["value", "other", "none"], [0.1, 0.5], task_rows=task_rows).collect()}
    assert np.allclose(found["value"], frame["value"].quantile([0.1, 0.5]))
    assert np.allclose(found["other"], frame["other"].quantile([0.1, 0.5]))
    assert not found["none"]


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_ranges(spark, skewed, descending):
    counts = ordered.value_counts(spark.createDataFrame(skewed), ["key"], "value")
    small = ordered.running_totals(counts, ["key"], "value", ["rows"], descending=descending)
    split = ordered.running_totals(counts, ["key"], "value", ["rows"], descending=descending, task_rows=60)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, split.collect()))


def test_running_totals_over_text_ranges(spark):
    df = spark.range(500).selectExpr("concat('v', cast(id * 7919 % 1000 AS string)) AS value", "CAST(1 AS BIGINT) AS one")
    split = ordered.running_totals(df, [], "value", ["one"], task_rows=40).collect()
    order = sorted(r["value"] for r in split)
    assert {r["value"]: r["one_upto"] for r in split} == {v: i + 1 for i, v in enumerate(order)}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.integers(-50, 50), min_size=3, max_size=120),
    task_rows=st.sampled_from([5, 20, 1_000_000]),
)
def test_values_at_ranks(spark, values, task_rows):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    ranks = [0, len(values) // 2, len(values) - 1]
    counts = written(ordered.value_counts(df, [], "v"), "counts")
    found = ordered.values_at_ranks(counts, "v", ranks, task_rows=task_rows)
    expected = sorted(values)
    for rank, (value, below) in zip(ranks, found):
        assert value == expected[rank]
        assert below == sum(v < value for v in values)


def test_brackets_that_miss_fall_back_to_all_values(spark, skewed, monkeypatch):
    df = spark.createDataFrame(skewed[["value"]])
    good = ordered._brackets(ordered._cells(df, ["value"]), [0.5])
    monkeypatch.setattr(ordered, "_brackets", lambda *_: {c: (n, [-2.0], [-1.0]) for c, (n, _, _) in good.items()})
    found = ordered.column_quantiles(df, ["value"], [0.5], task_rows=50).first()["quantiles"]
    assert np.allclose(found, skewed["value"].quantile([0.5]))


def test_heavy_keys_in_lookups(spark, skewed):
    from pyspark.sql import functions as F

    from ledgerlens.operators.enrich import lookup_map

    df = spark.createDataFrame(skewed).withColumn("key", F.when(F.col("key") != "k3", F.col("key")))
    table = df.groupBy("key").agg(F.count(F.lit(1)).alias("freq")).where("NOT (key <=> 'k5')")
    values = {"n": ("freq", F.lit(0))}
    plain = lookup_map(df, F.col("key"), table, "key", values)
    split = lookup_map(df, F.col("key"), table, "key", values, rows="freq", task_rows=60)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    assert plain.where("key = 'k5'").agg(F.max("n")).first()[0] == 0
    assert plain.where("key IS NULL").agg(F.min("n")).first()[0] > 0


def test_many_columns_take_as_many_jobs_as_few(spark):
    """Both above what one task holds: the scans don't grow with the columns."""
    rng = np.random.default_rng(3)
    wide = pd.DataFrame({f"c{i}": np.round(rng.exponential(10 + i, 4000), 1) for i in range(40)})
    wide.iloc[::3, 5] = np.nan
    df = spark.createDataFrame(wide.astype(object).where(wide.notna(), None), ", ".join(f"{c} double" for c in wide)).cache()
    df.count()
    jobs = {}
    for n in (2, 40):
        spark.sparkContext.setJobGroup(f"columns-{n}", "")
        probabilities = [0, 0.1, 0.25, 0.5, 0.9, 1]
        found = ordered.column_quantiles(df, list(wide)[:n], probabilities, rows=10_000_000).collect()
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"columns-{n}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(found) == n
        for r in found:
            assert np.allclose(r["quantiles"], wide[r["column"]].quantile(probabilities)), r["column"]
    assert jobs[2] == jobs[40]


def test_medians_on_both_sides_of_the_limit(spark):
    rng = np.random.default_rng(4)
    wide = pd.DataFrame({f"c{i}": np.round(rng.normal(0, 1 + i, 500), 2) for i in range(6)})
    df = spark.createDataFrame(wide)
    results = [
        {r["column"]: r["median"] for r in encoding.numeric_median_fit(df, list(wide), task_rows=limit).collect()}
        for limit in (499, 500, 2999, 3000, 1_000_000)
    ]
    assert all(r == results[0] for r in results) and np.allclose(list(results[0].values()), wide[list(results[0])].median())
