"""Feature sets on tiny frames with known answers."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.guards import SchemaError
from ledgerlens.plans import features_v1, features_v2


@pytest.fixture
def state(train_frame):
    return features_v2.fit(train_frame)


def rows_by_id(df):
    return {r["TransactionID"]: r for r in df.collect()}


def test_required_columns(train_frame):
    with pytest.raises(SchemaError, match="Missing required columns"):
        features_v2.fit(train_frame.drop("TransactionDT"))


def test_fit_transform_values(train_frame, state):
    out = rows_by_id(features_v2.transform(train_frame, state, keep=["TransactionID"]))
    assert out[2]["TransactionAmt"] == 200.0
    assert [out[i]["TransactionAmt_was_missing"] for i in (1, 2, 3)] == [0, 1, 0]
    assert out[2]["card4"] == "__MISSING__" and out[3]["P_emaildomain"] == "__MISSING__"
    assert [out[i]["transaction_hour"] for i in (1, 2, 3)] == [1, 2, 1]
    assert [out[i]["transaction_day"] for i in (1, 2, 3)] == [0, 0, 1]
    assert [out[i]["card1_frequency"] for i in (1, 2, 3)] == [2, 2, 1]
    assert out[3]["card2_frequency"] == 1  # the missing token has a training count
    assert out[1]["card3_addr2_interaction"] == "150.0__87.0"
    assert out[3]["identity_missing_count"] == 1 and out[2]["identity_missing_count"] == 0


def test_column_types(state):
    assert {"card1", "card2", "card3", "addr1", "id_12"} <= set(state.categorical)
    assert {"TransactionAmt", "TransactionDT"} <= set(state.numeric)


def test_schema_is_frozen_and_clean(train_frame, state):
    out = features_v2.transform(train_frame.withColumn("extra", F.lit(1)), state)
    assert out.columns == state.features
    assert len(set(state.features)) == len(state.features)
    assert not {"TransactionID", "isFraud", "uid_time_to_next"} & set(out.columns)


def test_unseen_rows_use_fitted_state(spark, train_frame, state):
    new = train_frame.limit(1).select(
        F.lit(4).cast("bigint").alias("TransactionID"),
        F.lit(180000).cast("bigint").alias("TransactionDT"),
        F.lit("not-a-number").alias("TransactionAmt"),
        F.lit(9999).cast("bigint").alias("card1"),
        F.lit(None).cast("double").alias("card2"),
        F.lit(150.0).alias("card3"),
        F.lit("discover").alias("card4"),
        F.lit(999.0).alias("card5"),
        F.lit("charge").alias("card6"),
        F.lit(999.0).alias("addr1"),
        F.lit(999.0).alias("addr2"),
        F.lit(999).cast("bigint").alias("id_12"),
        F.lit(None).cast("double").alias("id_13"),
        F.lit("new.example").alias("P_emaildomain"),
        F.lit("new.example").alias("R_emaildomain"),
        F.lit("S").alias("ProductCD"),
        F.lit(None).cast("string").alias("DeviceType"),
        F.lit("new-device").alias("DeviceInfo"),
    )
    row = features_v2.transform(new, state).first()
    assert row["TransactionAmt"] == 200.0 and row["TransactionAmt_was_missing"] == 1
    assert row["card2"] == "__MISSING__"
    assert {row[c] for c in ("card4", "id_12", "P_emaildomain", "ProductCD", "card3_addr2_interaction")} == {"__UNKNOWN__"}
    assert row["card1_frequency"] == 0 and row["addr1_frequency"] == 0


def test_absent_columns_at_transform(train_frame, state):
    out = features_v2.transform(train_frame.drop("DeviceInfo", "id_13"), state, keep=["TransactionID"])
    rows = rows_by_id(out)
    assert out.columns[1:] == state.features
    assert all(r["DeviceInfo"] == "__MISSING__" and r["DeviceInfo_missing_flag"] == 1 for r in rows.values())


def test_state_round_trip_and_refusals(spark, train_frame, state, tmp_path):
    path = str(tmp_path / "state_v2")
    features_v2.save_state(state, path, {"threshold": 0.1})
    again = features_v2.load_state(spark, path)
    left = rows_by_id(features_v2.transform(train_frame, state, keep=["TransactionID"]))
    assert rows_by_id(features_v2.transform(train_frame, again, keep=["TransactionID"])) == left
    assert again.extra == {"threshold": 0.1}
    with pytest.raises(FileExistsError):
        features_v2.save_state(state, path)
    with pytest.raises(ValueError, match="v1"):
        features_v2.save_state(state, str(tmp_path / "state_v1"))
    with pytest.raises(FileNotFoundError):
        features_v2.load_state(spark, str(tmp_path / "nothing"))


def test_v1_schema_and_contract(train_frame):
    state = features_v1.fit(train_frame)
    assert state.features[-6:] == ["day", "hour", "card1_freq", "card2_freq", "card3_freq", "card4_freq"]
    assert state.contract[-7:] == features_v1.CONTRACT_TAIL
    rows = rows_by_id(features_v1.transform(train_frame, state, state.contract, key="TransactionID"))
    assert all(r["uid_time_to_next"] == 0 and r["uid_time_from_prev"] == 0 for r in rows.values())
    assert rows[1]["uid_txn_count"] == 2 and rows[1]["uid_amt_mean"] == 100.0 and rows[3]["uid_amt_std"] == 0.0


def test_v1_unseen_values(train_frame):
    state = features_v1.fit(train_frame)
    new = train_frame.where("TransactionID = 1").withColumns({"card1": F.lit(9).cast("bigint"), "card4": F.lit("amex")})
    row = features_v1.transform(new, state, state.contract).first()
    assert row["card4"] is None and row["card1_freq"] == 0 and row["card4_freq"] == 0
    assert row["uid_txn_count"] == 1 and row["uid_amt_mean"] == 200.0 and row["uid_amt_median"] == 200.0
