"""Joins, splits, guards, sources."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import drift, enrich, guards, missed, profile, splits
from ledgerlens.operators.encoding import ordinal_standardize
from ledgerlens.sources import files


@pytest.fixture
def pair(spark):
    transactions = spark.createDataFrame(
        [(1, 400, 0), (2, 100, 1), (3, 300, 0), (4, 200, 1)], "TransactionID bigint, TransactionDT bigint, isFraud int"
    )
    identity = spark.createDataFrame(
        [(1, "desktop", "windows"), (3, "mobile", "ios"), (999, "desktop", "unused")],
        "TransactionID bigint, DeviceType string, DeviceInfo string",
    )
    return transactions, identity


def test_enrich_keeps_all_transactions(pair):
    rows = {r["TransactionID"]: r for r in enrich.enrich_identity(*pair).collect()}
    assert set(rows) == {1, 2, 3, 4}
    assert rows[1]["DeviceType"] == "desktop" and rows[2]["DeviceType"] is None


def test_enrich_guards(pair):
    transactions, identity = pair
    with pytest.raises(guards.SchemaError):
        enrich.enrich_identity(transactions.drop("TransactionID"), identity)
    with pytest.raises(guards.SchemaError):
        enrich.enrich_identity(transactions, identity.drop("TransactionID"))
    with pytest.raises(guards.SchemaError):
        enrich.enrich_identity(transactions.drop("isFraud"), identity)
    with pytest.raises(guards.SchemaError):
        enrich.enrich_identity(transactions, identity.withColumn("isFraud", F.lit(0)))


def test_curated_refuses_repeated_keys(pair):
    transactions, identity = pair
    assert enrich.build_curated(transactions, identity).count() == 4
    with pytest.raises(guards.SchemaError, match="one-to-one"):
        enrich.build_curated(transactions, identity.union(identity.limit(1)))


@pytest.mark.parametrize("task_rows", [1_000_000, 4])
def test_time_split(split_frame, task_rows):
    rows = splits.split_by_time_ratio(split_frame, task_rows=task_rows).orderBy("TransactionDT").collect()
    assert [r["split"] for r in rows] == ["train"] * 14 + ["validation"] * 3 + ["test"] * 3
    assert rows[0]["TransactionID"] == 20


@pytest.mark.parametrize("task_rows", [1_000_000, 4])
def test_time_split_cuts_inside_ties(spark, task_rows):
    df = spark.range(40).selectExpr("id AS TransactionID", "CAST(7 AS BIGINT) AS TransactionDT", "0 AS isFraud")
    rows = {r["TransactionID"]: r["split"] for r in splits.split_by_time_ratio(df, task_rows=task_rows).collect()}
    assert [rows[i] for i in range(40)] == ["train"] * 28 + ["validation"] * 6 + ["test"] * 6


@pytest.mark.parametrize("task_rows", [1_000_000, 3])
@pytest.mark.parametrize("untimed", [4, 12])
def test_rows_without_a_time_come_last(spark, task_rows, untimed):
    rows = [(i, None if i <= untimed else 100 * i, 0) for i in range(1, 21)]
    df = spark.createDataFrame(rows, "TransactionID bigint, TransactionDT bigint, isFraud int")
    got = {r["TransactionID"]: r["split"] for r in splits.split_by_time_ratio(df, task_rows=task_rows).collect()}
    ordered = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    assert [got[r[0]] for r in ordered] == ["train"] * 14 + ["validation"] * 3 + ["test"] * 3


def test_nan_is_missing(spark):
    rows = [(float(i % 7), float("nan") if i % 3 == 0 else 1.0, i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "x double, y double, isFraud int")
    clean = df.withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    for f in (
        profile.missing_summary,
        lambda d: profile.missing_signal_strength(d, min_missing_percent=10),
        lambda d: profile.describe(d, "y"),
        profile.label_correlation_topk,
        lambda d: profile.mean_shift(d.withColumn("split", F.lit("a")), "y"),
        lambda d: drift.drift_report(clean, d, ["x", "y"]),
        lambda d: drift.drift_report(d, clean, ["x", "y"]),
    ):
        assert sorted(map(str, f(df).collect())) == sorted(map(str, f(clean).collect()))
    assert {r["column"]: r["missing_count"] for r in profile.missing_summary(df).collect()}["y"] == 20


def test_scratch_is_deleted(spark):
    from ledgerlens.session import scope, written

    with scope(spark):
        kept = written(spark.range(5).toDF("x"), "gone")
        path = kept.inputFiles()[0]
        assert files.exists(spark, path)
    assert not files.exists(spark, path)


def test_time_split_refusals(split_frame):
    with pytest.raises(ValueError, match="sum to 1.0"):
        splits.split_by_time_ratio(split_frame, 0.7, 0.2, 0.2)
    with pytest.raises(ValueError, match="positive"):
        splits.split_by_time_ratio(split_frame, 1.0, 0.0, 0.0)
    with pytest.raises(ValueError, match="at least 3"):
        splits.split_by_time_ratio(split_frame.limit(2))
    with pytest.raises(guards.SchemaError):
        splits.split_by_time_ratio(split_frame.drop("isFraud"))


def test_load_dataset_refusals(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported"):
        files.load_dataset(spark, str(tmp_path / "x.json"))
    with pytest.raises(FileNotFoundError):
        files.load_dataset(spark, str(tmp_path / "x.parquet"))
    with pytest.raises(FileNotFoundError):
        files.read_zone(spark, str(tmp_path), "raw", "nothing")
    with pytest.raises(ValueError, match="zone"):
        files.read_zone(spark, str(tmp_path), "elsewhere", "nothing")


def test_conversion_leaves_existing_targets(spark, tmp_path):
    spark.range(3).write.option("header", True).csv(str(tmp_path / "in" / "t.csv"))
    schemas = {"t": "id bigint"}
    assert files.csv_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out"), schemas) == ["t"]
    assert files.csv_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out"), schemas) == []


def test_contract_fails_closed(spark):
    df = spark.createDataFrame([(1.0, float("nan"))], "a double, b double")
    assert guards.fail_on_violations(df.select("a"), ["a"]).count() == 1
    with pytest.raises(guards.SchemaError, match="non_finite"):
        guards.fail_on_violations(df, ["a", "b"])
    with pytest.raises(guards.SchemaError, match="order"):
        guards.fail_on_violations(df.selectExpr("2 AS b", "a"), ["a", "b"])


def test_class_weight_refuses_one_class(spark):
    with pytest.raises(Exception, match="empty class"):
        profile.scale_pos_weight(spark.createDataFrame([(0,), (0,)], "isFraud int")).collect()


def test_missed_groups(spark):
    schema = (
        "ProductCD string, card1 int, TransactionAmt double, TransactionDT bigint, id_01 double, id_02 double, "
        "isFraud int, score double"
    )
    rows = [
        ("W", 1001, 10.0, 3600, None, None, 1, 0.10),
        ("W", 1001, 20.0, 7200, None, None, 1, 0.15),
        ("C", 1002, 300.0, 43200, 1.0, 2.0, 1, 0.80),
        ("C", 1002, 400.0, 68400, None, None, 0, 0.05),
        ("C", 1003, 900.0, 80000, None, None, 0, 0.01),
    ]
    flagged = missed.add_bands(missed.outcome_flags(spark.createDataFrame(rows, schema), 0.20))
    top = missed.top_fn_groups(flagged, ["ProductCD", "TransactionAmt_band", "identity_missing_count_band"], 5).collect()
    product = next(r for r in top if r["group_column"] == "ProductCD")
    assert (product["group_value"], product["false_negatives"], product["missed_fraud_rate"]) == ("W", 2, 1.0)
    assert flagged.where("_is_false_negative").count() == 2 and flagged.where("_y_true = 1").count() == 3


def test_missed_groups_full_row(spark):
    rows = [("mobile", 1, True, False), ("mobile", 0, False, False), ("desktop", 1, False, True), ("desktop", 0, False, False)]
    flagged = spark.createDataFrame(
        rows, "DeviceType string, _y_true int, _is_false_negative boolean, _is_true_positive boolean"
    )
    assert [r.asDict() for r in missed.top_fn_groups(flagged, ["DeviceType"]).collect()] == [
        {
            "group_column": "DeviceType",
            "group_value": "mobile",
            "false_negatives": 1,
            "true_positives": 0,
            "fraud_count": 1,
            "non_fraud_count": 1,
            "total_count": 2,
            "missed_fraud_rate": 1.0,
            "false_negative_share": 1.0,
            "fraud_rate": 0.5,
        }
    ]


@pytest.mark.parametrize("task_rows", [1_000_000, 1])
def test_ordinal_encoding(spark, task_rows):
    schema = "key bigint, number double, category string, many string"
    train = spark.createDataFrame(
        [(1, 1.0, "known_a", "id_1"), (2, 2.0, "known_b", "id_2"), (3, 3.0, "known_a", "id_3")], schema
    )
    other = spark.createDataFrame([(9, 2.0, "unseen", "id_99")], schema)
    out = ordinal_standardize(train, other, "key", task_rows=task_rows)
    assert out.columns == ["key", "number", "category", "many"]
    assert tuple(out.first()) == (9, 0.0, 0.0, 0.0)
    codes = ordinal_standardize(train, train, "key", task_rows=task_rows).orderBy("key").collect()
    assert [r["many"] for r in codes] == [1.0, 2.0, 3.0] and [r["category"] for r in codes] == [1.0, 2.0, 1.0]
