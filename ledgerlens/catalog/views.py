"""Transaction-shaped views over the given tables, one text for both engines.

Each view is a projection (``ident`` and ``preds`` with a filter or a small
factor) of ``events``, so its work grows with that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH_START = 1704067200
K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k"

TXN = [
    "event_id AS TransactionID",
    f"CAST(floor({{EPOCH}}) AS BIGINT) - {EPOCH_START} AS TransactionDT",
    "CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS TransactionAmt",
    "CASE event_type WHEN 'purchase' THEN 'W' WHEN 'click' THEN 'C' WHEN 'view' THEN 'R' "
    "WHEN 'signup' THEN 'H' ELSE 'S' END AS ProductCD",
    "user_id AS card1",
    "nullif(k % 10, 0) AS card2",
    "150 + 35 * CAST(k % 2 AS INT) AS card3",
    "CASE k % 4 WHEN 1 THEN 'visa' WHEN 2 THEN 'mastercard' WHEN 3 THEN 'discover' END AS card4",
    "CASE WHEN k % 3 = 0 THEN 'credit' ELSE 'debit' END AS card6",
    "nullif(k % 5, 0) * 100 AS addr1",
    "CASE WHEN k % 3 = 0 THEN NULL ELSE 87 END AS addr2",
    "CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN 'yahoo.com' ELSE 'gmail.com' END AS P_emaildomain",
    "CASE WHEN event_id % 5 = 0 THEN 'gmail.com' END AS R_emaildomain",
    "CASE WHEN event_type = 'error' AND k < 40 THEN 1 ELSE 0 END AS isFraud",
    "CAST(CASE WHEN event_type = 'error' THEN 3000 ELSE 0 END + (99 - k) * 50 "
    "+ (event_id * 7919) % 2000 AS DOUBLE) / 10000 AS score",
]
IDENT = [
    "event_id AS TransactionID",
    "CASE WHEN k % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS DeviceType",
    "CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 'ios' WHEN 2 THEN 'windows' WHEN 3 THEN 'android' "
    "ELSE 'macos' END AS DeviceInfo",
    "nullif(k % 7, 0) AS id_01",
    "nullif(k % 11, 0) AS id_02",
    "CASE WHEN k < 50 THEN 'Found' END AS id_12",
]
CANDIDATES = [("base", 1, 7919), ("w3", 3, 104729), ("w5", 5, 1299709)]
PREDS = [
    "event_id AS TransactionID",
    "candidate",
    "weight AS scale_pos_weight",
    "CASE WHEN event_id % 2 = 0 THEN 'validation' ELSE 'test' END AS split",
    "CASE WHEN event_type = 'error' AND k < 40 THEN 1 ELSE 0 END AS y",
    "CAST(CASE WHEN event_type = 'error' THEN 3000 ELSE 0 END + (99 - k) * 50 "
    "+ (event_id * mult) % 2000 AS DOUBLE) / 10000 AS p",
]
LOG = [
    "ts",
    "event_id",
    "CASE WHEN event_id % 3 = 0 THEN '/predict/v2' ELSE '/predict' END AS endpoint",
    "CASE WHEN event_id % 3 = 0 THEN 'v2' ELSE 'v1' END AS model_version",
    "CASE WHEN event_id % 3 = 0 THEN 'catboost' ELSE 'lightgbm' END AS model_family",
    "CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status",
    "value AS latency_ms",
    "CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS fraud_prediction",
]
REQUESTS = [
    "event_id AS request_id",
    "concat(CASE event_type WHEN 'error' THEN 'Analyze fraud risk for transaction TX-' "
    "WHEN 'view' THEN 'Review model monitoring metrics, txn_' "
    "WHEN 'click' THEN 'Give rollback guidance for transaction ' ELSE 'hello ' END, "
    "CAST(event_id AS VARCHAR(20)), ' for v', CAST(1 + event_id % 2 AS VARCHAR(4)), "
    "' from 2026-06-01 at threshold 0.', CAST(10 + event_id % 90 AS VARCHAR(4)), "
    "CASE WHEN event_id % 3 = 0 THEN ' high risk' ELSE '' END) AS text",
]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream, event time as a timestamp."""
    schema = events(spark, sf_dir).schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _spark(texts: list[str]) -> list[str]:
    return [t.replace("{EPOCH}", "unix_timestamp(ts)").replace("VARCHAR(20)", "STRING").replace("VARCHAR(4)", "STRING") for t in texts]


def as_txn(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("*", K).selectExpr(*_spark(TXN))


def as_log(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(*_spark(LOG))


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_txn(events(spark, sf_dir))


def ident(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr("*", K).where("event_id % 4 = 0").selectExpr(*_spark(IDENT))


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event scored by three candidates: a factor of three on each row."""
    structs = ", ".join(f"struct('{n}' AS candidate, {w} AS weight, {m} AS mult)" for n, w, m in CANDIDATES)
    rows = events(spark, sf_dir).selectExpr("*", K).selectExpr("*", f"inline(array({structs}))")
    return rows.selectExpr(*_spark(PREDS))


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_log(events(spark, sf_dir))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(*_spark(REQUESTS))


def _duck(texts: list[str]) -> str:
    return ", ".join(t.replace("{EPOCH}", "epoch(ts)") for t in texts)


_E = f"(SELECT *, {K} FROM events) e"
_C = "(SELECT * FROM (VALUES " + ", ".join(f"('{n}', {w}, {m})" for n, w, m in CANDIDATES) + ") AS t(candidate, weight, mult)) c"
SQL = {
    "txn": f"SELECT {_duck(TXN)} FROM {_E}",
    "ident": f"SELECT {_duck(IDENT)} FROM {_E} WHERE event_id % 4 = 0",
    "preds": f"SELECT {_duck(PREDS)} FROM {_E} CROSS JOIN {_C}",
    "prediction_log": f"SELECT {_duck(LOG)} FROM events",
    "requests": f"SELECT {_duck(REQUESTS)} FROM events",
}
