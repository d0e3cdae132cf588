"""Scans, sources and sinks."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ledgerlens.catalog import views
from ledgerlens.catalog.helpers import joined, later_rows, train_rows
from ledgerlens.catalog.registry import query
from ledgerlens.plans import features_v2
from ledgerlens.session import scratch
from ledgerlens.sources import events, files
from ledgerlens.streaming.sinks import run_to_parquet

ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice"


def _orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(*ORDER_COLUMNS.split(", "))


@query("csv_to_parquet", f"SELECT {ORDER_COLUMNS} FROM orders")
def _(spark, sf_dir):
    root = scratch(spark, "csv")
    _orders(spark, sf_dir).write.option("header", True).csv(f"{root}/in/orders.csv")
    files.csv_to_parquet(spark, f"{root}/in", f"{root}/out", {"orders": ORDER_SCHEMA})
    files.csv_to_parquet(spark, f"{root}/in", f"{root}/out", {"orders": ORDER_SCHEMA})
    return files.load_dataset(spark, f"{root}/out/orders.parquet")


@query("load_dataset", f"SELECT {ORDER_COLUMNS}, 'csv' AS source FROM orders UNION ALL SELECT {ORDER_COLUMNS}, 'parquet' FROM orders")
def _(spark, sf_dir):
    root = scratch(spark, "load")
    _orders(spark, sf_dir).write.option("header", True).csv(f"{root}/orders.csv")
    from_csv = files.load_dataset(spark, f"{root}/orders.csv", ORDER_SCHEMA)
    from_parquet = files.load_dataset(spark, f"{sf_dir}/orders.parquet").selectExpr(*ORDER_COLUMNS.split(", "))
    return from_csv.withColumn("source", F.lit("csv")).unionByName(from_parquet.withColumn("source", F.lit("parquet")))


@query("read_zone", "SELECT * FROM txn", ["txn"])
def _(spark, sf_dir):
    root = scratch(spark, "lake")
    files.write_zone(views.txn(spark, sf_dir), root, "raw", "train_transaction")
    return files.read_zone(spark, root, "raw", "train_transaction")


@query(
    "write_zone",
    "SELECT ProductCD, CAST(floor(TransactionDT / 86400) AS INT) AS day, count(*) AS n FROM txn GROUP BY ALL",
    ["txn"],
)
def _(spark, sf_dir):
    root = scratch(spark, "lake")
    rows = views.txn(spark, sf_dir).withColumn("day", F.floor(F.col("TransactionDT") / 86400).cast("int"))
    files.write_zone(rows, root, "curated", "transactions", ["day"])
    table = files.read_zone(spark, root, "curated", "transactions")
    return table.groupBy("ProductCD", "day").agg(F.count(F.lit(1)).alias("n"))


@query(
    "save_load_fit_state",
    """SELECT t.TransactionID, CAST(coalesce(f.freq, 0) AS BIGINT) AS card1_frequency,
              coalesce(t.TransactionAmt, m.median) AS TransactionAmt
       FROM txn t LEFT JOIN f USING (card1) CROSS JOIN m WHERE t.TransactionDT >= 1728000""",
    ["txn"],
    {
        "f": "SELECT card1, count(*) AS freq FROM txn WHERE TransactionDT < 1728000 GROUP BY card1",
        "m": "SELECT median(TransactionAmt) AS median FROM txn WHERE TransactionDT < 1728000",
    },
)
def _(spark, sf_dir):
    rows = joined(spark, sf_dir).drop("score")
    path = scratch(spark, "state") + "/state_v2"
    features_v2.save_state(features_v2.fit(train_rows(rows)), path, {"threshold": 0.2})
    state = features_v2.load_state(spark, path)
    features = features_v2.transform(later_rows(rows), state, keep=["TransactionID"])
    return features.select("TransactionID", F.col("card1_frequency").cast("bigint"), "TransactionAmt")


@query(
    "append_prediction_log",
    "SELECT event_id, endpoint, model_version, model_family, status, fraud_prediction FROM prediction_log",
    ["prediction_log"],
)
def _(spark, sf_dir):
    path = scratch(spark, "log")
    log = views.prediction_log(spark, sf_dir).select(
        "event_id", "endpoint", "model_version", "model_family", "status", "fraud_prediction"
    )
    events.append_prediction_log(log.where("event_id % 2 = 0"), path)
    events.append_prediction_log(log.where("event_id % 2 = 1"), path)
    return spark.read.schema(log.schema.add("ts_utc", "string")).json(path).drop("ts_utc")


MESSAGE_COLUMNS = [f.name for f in events.TRANSACTION_SCHEMA.fields]
MESSAGE_SQL = (
    "SELECT TransactionID, TransactionDT, TransactionAmt, ProductCD, card1, CAST(card2 AS BIGINT) AS card2, "
    "CAST(card3 AS BIGINT) AS card3, card4, CAST(addr1 AS BIGINT) AS addr1 FROM txn"
)


def messages(rows, empty=""):
    """Transaction messages with a field of their own; every hundredth one is broken, every 101st empty or without fields.

    Every seventh one writes its time as 5.0 instead of 5.
    """
    key = F.col("TransactionID")
    whole = F.struct(*MESSAGE_COLUMNS, F.lit("app").alias("channel"))
    loose = F.struct(
        *[F.col(c).cast("double").alias(c) if c == "TransactionDT" else F.col(c) for c in MESSAGE_COLUMNS], F.lit("app").alias("channel")
    )
    text = F.when(key % 7 == 0, F.to_json(loose)).otherwise(F.to_json(whole))
    broken = F.when(key % 100 == 99, F.concat(F.lit("{oops "), text)).when(key % 202 == 100, F.lit("{}")).when(
        key % 101 == 100, F.lit(empty)
    )
    return rows.select(broken.otherwise(text).alias("value"))


def message_stream(spark, sf_dir):
    return messages(views.as_txn(views.event_stream(spark, sf_dir)))


READABLE = "WHERE TransactionID % 100 <> 99 AND TransactionID % 101 <> 100"


@query("stream_read_transactions", f"{MESSAGE_SQL} {READABLE}", ["txn"])
def _(spark, sf_dir):
    parsed = events.parse_event_json(message_stream(spark, sf_dir))
    return run_to_parquet(events.good_events(parsed), "transactions")


@query("stream_write_transactions", MESSAGE_SQL, ["txn"])
def _(spark, sf_dir):
    path = scratch(spark, "topic")
    rows = views.as_txn(views.event_stream(spark, sf_dir)).select(*MESSAGE_COLUMNS)
    run_to_parquet(events.to_messages(rows), "topic", path)
    back = events.parse_event_json(spark.read.schema("value string").parquet(path))
    return events.good_events(back)


# The columns in name order, as texts that both engines write alike: numbers with a point as decimals, times in microseconds.
PRINTED = {
    "events": "event_id, event_type, props, epoch_us(ts) AS ts, user_id, CAST(value AS DECIMAL(18, 6)) AS value",
    "orders": "o_custkey, epoch_us(o_orderdate) AS o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, "
    "CAST(o_totalprice AS DECIMAL(18, 6)) AS o_totalprice",
    "customer": "CAST(c_acctbal AS DECIMAL(18, 6)) AS c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey",
    "txn": "P_emaildomain, ProductCD, CAST(TransactionAmt AS DECIMAL(18, 6)) AS TransactionAmt, TransactionDT, TransactionID, card1",
}


def _fingerprint_sql(table: str, name: str, role: str, columns: str) -> str:
    names = [c.split(" AS ")[-1] for c in re.split(r", (?![^(]*\))", columns)]
    text = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in names)
    halves = ", ".join(
        f"CAST(sum(CAST(CAST('0x' || substr(h, {at}, 16) AS UBIGINT) AS HUGEINT)) AS VARCHAR) AS {half}_hash"
        for half, at in (("high", 1), ("low", 17))
    )
    return (
        f"SELECT '{name}' AS \"table\", CAST({len(names)} AS INTEGER) AS columns, count(*) AS rows, {halves}, '{role}' AS role, "
        f"'batch' AS run_id, 'batch_scoring' AS stage FROM (SELECT md5({text}) AS h FROM (SELECT {columns} FROM {table}) p) q"
    )


@query(
    "dataset_fingerprint",
    " UNION ALL ".join(
        _fingerprint_sql(t, n, r, PRINTED[t])
        for t, n, r in [("events", "events", "input"), ("orders", "orders", "input"), ("customer", "customer", "input"), ("txn", "transactions", "output")]
    ),
    ["txn"],
)
def _(spark, sf_dir):
    def printed(df, table):
        return df.selectExpr(*[c.replace("epoch_us(", "unix_micros(") for c in re.split(r", (?![^(]*\))", PRINTED[table])])

    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("events", "orders", "customer")}
    times = {"events": "ts", "orders": "o_orderdate"}
    tables = {n: df.withColumn(times[n], F.col(times[n]).cast("timestamp")) if n in times else df for n, df in tables.items()}
    outputs = {"transactions": printed(views.txn(spark, sf_dir), "txn")}
    manifest = files.run_manifest("batch", "batch_scoring", {n: printed(df, n) for n, df in tables.items()}, outputs)
    return manifest.drop("created_utc")


@query("sample_rows", "SELECT * FROM txn ORDER BY md5('42:' || CAST(TransactionID AS VARCHAR)), TransactionID LIMIT 20", ["txn"])
def _(spark, sf_dir):
    return files.sample_rows(views.txn(spark, sf_dir), "TransactionID", 20)


