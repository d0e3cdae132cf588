"""Field extraction and routing for analyst request text, as column expressions.

The patterns, word lists and their order are fixed values of the request
contract; matching runs in the JVM over the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns.
TRANSACTION_WORD = r"(?i)(?:transaction(?:\s*id)?|txn)\s*[:#]?\s*([A-Za-z0-9_-]+)"
TRANSACTION_CODE = r"(?i)\b((?:TX|txn)[-_]?\d+)\b"
ISO_DATE = r"\b(\d{4}-\d{2}-\d{2})\b"
MODEL_VERSION = r"\b(v[12])\b"
THRESHOLD = r"threshold\s*(?:=|to|at|:)?\s*(0?\.\d+|1(?:\.0+)?)"

# Word lists, tested in this order.
RISK_WORDS = ["low", "medium", "high", "critical"]
ROLLBACK_TERMS = ["rollback", "roll back", "revert release", "disable v2"]
MONITOR_TERMS = ["monitor", "metrics", "latency", "alert rate", "error rate", "grafana", "prometheus"]
RISK_TERMS = ["fraud", "risk", "transaction", "false positive", "false negative", "threshold"]
APPROVAL_TERMS = [
    "block transaction",
    "approve transaction",
    "decline transaction",
    "change threshold",
    "set threshold",
    "deploy",
    "promote model",
    "trigger rollback",
    "rollback now",
    "disable /predict/v2",
]
SEVERE_TERMS = ["stolen", "chargeback", "account takeover", "very large"]
UNCLEAR_TERMS = ["unknown", "missing", "malformed", "insufficient"]
FAILURE_TERMS = ["force_tool_failure", "simulate tool failure"]


def _has_any(lowered: Column, terms: list[str]) -> Column:
    found = F.lit(False)
    for term in terms:
        found = found | F.contains(lowered, F.lit(term))
    return found


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def extract_request_fields(df: DataFrame, text: str = "text") -> DataFrame:
    """Add transaction ids, dates, versions, thresholds, risk words and the empty flag."""
    body = F.coalesce(F.col(text), F.lit(""))
    lowered = F.lower(body)
    ids = F.concat(_all(body, TRANSACTION_WORD), _all(body, TRANSACTION_CODE))
    words = F.array(*[F.when(F.rlike(lowered, F.lit(rf"\b{word}\b")), F.lit(word)) for word in RISK_WORDS])
    return df.withColumns(
        {
            "transaction_ids": F.array_sort(F.array_distinct(ids)),
            "date_ranges": _all(body, ISO_DATE),
            "model_versions": F.array_sort(F.array_distinct(_all(lowered, MODEL_VERSION))),
            "thresholds": F.transform(_all(lowered, THRESHOLD), lambda value: value.cast("double")),
            "risk_categories": F.filter(words, lambda word: word.isNotNull()),
            "malformed_or_missing_inputs": ~F.rlike(body, F.lit(r"\S")),
        }
    )


def route_requests(df: DataFrame, text: str = "text") -> DataFrame:
    """Add tool, approval flag and risk level by the ordered keyword rules."""
    fields = extract_request_fields(df, text)
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    tool = (
        F.when(_has_any(lowered, ROLLBACK_TERMS), "rollback_readiness")
        .when(_has_any(lowered, MONITOR_TERMS), "model_monitoring")
        .when(_has_any(lowered, RISK_TERMS), "fraud_risk_analysis")
        .otherwise("none")
    )
    approval = _has_any(lowered, APPROVAL_TERMS)
    risk = F.col("risk_categories")
    text_risk = (
        F.when(F.array_contains(risk, "critical") | F.array_contains(risk, "high"), "high")
        .when(F.array_contains(risk, "low"), "low")
        .when(_has_any(lowered, SEVERE_TERMS), "high")
        .when(_has_any(lowered, UNCLEAR_TERMS), "unknown")
        .otherwise("medium")
    )
    level = (
        F.when(_has_any(lowered, FAILURE_TERMS), "unknown")
        .when(F.col("tool") == "fraud_risk_analysis", text_risk)
        .when(F.col("tool") == "model_monitoring", "medium")
        .when((F.col("tool") == "rollback_readiness") & approval, "high")
        .when(F.col("tool") == "rollback_readiness", "medium")
        .otherwise("unknown")
    )
    # A rollback request always needs a person, unless the tool itself failed.
    needs_person = approval | ((F.col("tool") == "rollback_readiness") & ~_has_any(lowered, FAILURE_TERMS))
    return (
        fields.withColumn("tool", tool)
        .withColumns({"risk_level": level, "requires_human_approval": needs_person})
    )


def route_counts(df: DataFrame, text: str = "text") -> DataFrame:
    return (
        route_requests(df, text)
        .groupBy("tool", "risk_level", "requires_human_approval")
        .agg(F.count(F.lit(1)).alias("requests"))
    )
