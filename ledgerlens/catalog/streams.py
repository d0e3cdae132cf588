"""Streaming queries: the events table drained as a file stream, the sink table returned."""

from __future__ import annotations

from collections.abc import Callable
from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.catalog import views
from ledgerlens.catalog.helpers import UID, off_ties, rounded
from ledgerlens.catalog.registry import query
from ledgerlens.catalog.sources import READABLE, message_stream
from ledgerlens.functions.expressions import uid
from ledgerlens.operators import encoding
from ledgerlens.sources import events, files
from ledgerlens.streaming import history, scoring, windows
from ledgerlens.streaming.sinks import closing, rocksdb, run_to_parquet

W = "CAST(floor(epoch(ts) / 300) AS BIGINT) * 300"


def _windows(spark, sf_dir, name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All windows of the log, those open at its end too."""
    log, close = closing(views.as_log(views.event_stream(spark, sf_dir)), "ts")
    return run_to_parquet(build(log), name, close=close)


def _plain(table: DataFrame) -> DataFrame:
    """Window edges as epoch seconds."""
    return rounded(
        table.withColumns({c: F.unix_seconds(c) for c in ("window_start", "window_end")})
    )


def _rate_sql(keys: str, where: str = "") -> str:
    comma = f", {keys}" if keys else ""
    return f"""SELECT window_start, window_start + 300 AS window_end{comma}, count(*) AS requests,
        round(count(*) / 300, 6) AS per_second
      FROM (SELECT *, {W} AS window_start FROM prediction_log {where}) l GROUP BY ALL"""


LABELS = "endpoint, model_version, model_family, status"


@query("stream_request_rate", _rate_sql(LABELS), ["prediction_log"])
def _(spark, sf_dir):
    return _plain(_windows(spark, sf_dir, "request-rate", windows.request_rate))


@query(
    "stream_error_rate", _rate_sql("endpoint, model_version, model_family", "WHERE status = 'error'"), ["prediction_log"]
)
def _(spark, sf_dir):
    return _plain(_windows(spark, sf_dir, "error-rate", windows.error_rate))


@query(
    "stream_success_volume", _rate_sql("model_version, model_family", "WHERE status = 'success'"), ["prediction_log"]
)
def _(spark, sf_dir):
    return _plain(_windows(spark, sf_dir, "success", windows.success_volume))


@query("stream_endpoint_status", _rate_sql("status", "WHERE endpoint = '/predict/v2'"), ["prediction_log"])
def _(spark, sf_dir):
    return _plain(_windows(spark, sf_dir, "endpoint", lambda log: windows.endpoint_status(log, "/predict/v2", "v2", "catboost")))


def _quantile_sql(q: float, name: str) -> str:
    bounds = windows.LATENCY_BOUNDS
    steps = [(0.0, "0"), *[(b, f"le{i}") for i, b in enumerate(bounds)]]
    cases = " ".join(
        f"WHEN {upto} >= {q} * requests THEN {low!r} + {high - low!r} * ({q} * requests - {before}) / ({upto} - {before})"
        for (low, before), (high, upto) in pairwise(steps)
    )
    return f"round(CASE {cases} ELSE {bounds[-1]!r} END + 1e-9, 6) AS {name}"


@query(
    "stream_latency_quantiles",
    f"SELECT window_start, window_start + 300 AS window_end, {LABELS}, requests, "
    + ", ".join(_quantile_sql(q, n) for q, n in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")))
    + f" FROM (SELECT {W} AS window_start, {LABELS}, count(latency_ms) AS requests, "
    + ", ".join(f"count(*) FILTER (WHERE latency_ms / 1000 <= {b!r}) AS le{i}" for i, b in enumerate(windows.LATENCY_BOUNDS))
    + " FROM prediction_log GROUP BY ALL) c",
    ["prediction_log"],
)
def _(spark, sf_dir):
    table = _windows(spark, sf_dir, "latency", windows.latency_quantiles)
    return _plain(off_ties(table, "p50", "p95", "p99"))


SIZES = windows.ALERT_SIZES


@query(
    "rolling_alert_rate",
    "SELECT *, CASE WHEN alert_rate > 0.099 THEN 'critical' WHEN alert_rate > 0.0495 THEN 'warning' "
    "WHEN alert_rate < 0.02075 THEN 'drop' ELSE 'expected' END AS level FROM ("
    + " UNION ALL ".join(
        f"""SELECT pane - o AS window_start, pane - o + {s} AS window_end, '{name}' AS size, CAST(sum(n) AS BIGINT) AS requests,
              CAST(sum(a) AS BIGINT) AS alerts, round(sum(a) / sum(n), 6) AS alert_rate
            FROM panes CROSS JOIN generate_series(0, {s - 900}, 900) g(o) GROUP BY 1, 2"""
        for name, s in SIZES.items()
    )
    + ") r",
    ["prediction_log"],
    {
        "panes": "SELECT CAST(floor(epoch(ts) / 900) AS BIGINT) * 900 AS pane, count(*) AS n, sum(fraud_prediction) AS a "
        "FROM prediction_log WHERE status = 'success' GROUP BY 1"
    },
)
def _(spark, sf_dir):
    with rocksdb(spark):
        return _plain(_windows(spark, sf_dir, "alerts", windows.rolling_alert_rates))


@query(
    "stream_risk_tiers",
    """SELECT CASE WHEN score >= 0.8 THEN 'high_risk' WHEN score >= 0.5 THEN 'medium_risk' ELSE 'low_risk' END AS tier,
              count(*) AS rows FROM txn GROUP BY 1""",
    ["txn"],
)
def _(spark, sf_dir):
    return windows.stream_risk_tiers(views.as_txn(views.event_stream(spark, sf_dir)).select("score"))


FIT = {
    "st": f"SELECT {UID} AS uid, avg(TransactionAmt) AS m, coalesce(stddev_samp(TransactionAmt), 0) AS s FROM txn "
    "WHERE TransactionDT < 1728000 GROUP BY 1",
    "g": "SELECT avg(TransactionAmt) AS gm, stddev_samp(TransactionAmt) AS gs FROM txn WHERE TransactionDT < 1728000",
    "d": f"""SELECT TransactionID, 1 / (1 + exp(-coalesce((TransactionAmt - coalesce(m, gm)) / (coalesce(s, gs) + 1e-6), 0)))
               AS score FROM (SELECT *, {UID} AS uid FROM txn {READABLE}) t LEFT JOIN st USING (uid) CROSS JOIN g""",
}


@query(
    "stream_score",
    "SELECT TransactionID, round(score, 6) AS score, CAST(score >= 0.7 AS INT) AS fraud_prediction, "
    "CAST(0.7 AS DOUBLE) AS threshold FROM d",
    ["txn"],
    FIT,
)
def _(spark, sf_dir):
    train = views.txn(spark, sf_dir).where("TransactionDT < 1728000")
    stats = files.bucketed(encoding.uid_stats_fit(train), "uid", "uid_stats")
    mean, std = encoding.amount_totals(train)
    scored, _ = scoring.stream_score(
        message_stream(spark, sf_dir),
        lambda rows: scoring.stream_static_enrich(rows, stats, mean, std),
        scoring.deviation_scorer,
        0.7,
    )
    return rounded(scored.select("TransactionID", "score", "fraud_prediction", "threshold"))


@query(
    "stream_past_features",
    """SELECT DISTINCT uid, TransactionDT, count(*) OVER w AS past_rows, round(avg(TransactionAmt) OVER w + 1e-9, 6) AS past_mean,
              round(stddev_samp(TransactionAmt) OVER w, 6) AS past_std, min(TransactionAmt) OVER w AS past_min,
              max(TransactionAmt) OVER w AS past_max, round(median(TransactionAmt) OVER w + 1e-9, 6) AS past_median,
              TransactionDT - max(TransactionDT) OVER w AS seconds_since_previous
       FROM t WINDOW w AS (PARTITION BY uid ORDER BY TransactionDT RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    ["txn"],
    {"t": f"SELECT *, {UID} AS uid FROM txn"},
)
def _(spark, sf_dir):
    stream, close = closing(views.as_txn(views.event_stream(spark, sf_dir)), "TransactionDT")
    past = history.stream_past_features(stream, uid(), close=close)
    return rounded(off_ties(past, "past_mean", "past_median"))


CHECKED = ["TransactionAmt", "card2", "addr1", "ProductCD"]


@query(
    "stream_quality_counters",
    f"""SELECT 'rows' AS "check", '*' AS "column", count(*) AS violations FROM txn
        UNION ALL SELECT 'schema_failures', '*', count(*) FROM txn WHERE TransactionID % 100 = 99 OR TransactionID % 101 = 100
        UNION ALL SELECT 'absent', 'id_01', 1
        """
    + " ".join(f"UNION ALL SELECT 'null', '{c}', count(*) FROM txn {READABLE} AND {c} IS NULL" for c in CHECKED[:3]),
    ["txn"],
)
def _(spark, sf_dir):
    parsed = events.parse_event_json(message_stream(spark, sf_dir)).select(*CHECKED, "_bad")
    counters = scoring.stream_quality_counters(parsed, [*CHECKED, "id_01"])
    totals = counters.groupBy("check", "column").agg(F.sum("violations").alias("violations"))
    return totals.where((F.col("check") != "count") & (F.col("violations") > 0))
