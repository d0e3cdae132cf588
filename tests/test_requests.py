"""Request text: extracted fields and routing."""

import pytest

from ledgerlens.functions.requests import extract_request_fields, route_requests


def one(spark, text, function):
    return function(spark.createDataFrame([(text,)], "text string")).first()


def test_extracts_fields(spark):
    text = "Since 2025-11-30: was V1 right to pass TXN_48 and tx-7 when v2, threshold: .35, calls both high? Until 2025-12-02."
    row = one(spark, text, extract_request_fields)
    assert {"TXN_48", "tx-7"} <= set(row["transaction_ids"])
    assert row["model_versions"] == ["v1", "v2"] and row["thresholds"] == [0.35]
    assert row["malformed_or_missing_inputs"] is False and row["risk_categories"] == ["high"]
    assert row["date_ranges"] == ["2025-11-30", "2025-12-02"]


@pytest.mark.parametrize("text", ["", None, "  \n"])
def test_empty_requests(spark, text):
    row = one(spark, text, extract_request_fields)
    assert row["transaction_ids"] == [] and row["thresholds"] == [] and row["malformed_or_missing_inputs"] is True


def test_word_form_also_yields_the_tail(spark):
    assert one(spark, "see txn_22", extract_request_fields)["transaction_ids"] == ["_22", "txn_22"]


@pytest.mark.parametrize(
    ("text", "tool", "risk", "approval"),
    [
        ("nothing of the kind is asked here", "none", "unknown", False),
        ("simulate tool failure, then rate the fraud risk of txn 9", "fraud_risk_analysis", "unknown", False),
        ("how high is the fraud risk of card 4411?", "fraud_risk_analysis", "high", False),
        ("what would a roll back need?", "rollback_readiness", "medium", True),
        ("deploy the old version after the rollback", "rollback_readiness", "high", True),
        ("does monitoring show more alerts since Monday?", "model_monitoring", "medium", False),
    ],
)
def test_routes(spark, text, tool, risk, approval):
    row = one(spark, text, route_requests)
    assert (row["tool"], row["risk_level"], row["requires_human_approval"]) == (tool, risk, approval)
