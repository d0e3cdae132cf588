"""Windowed monitoring of the prediction log.

All aggregations are watermarked and append-only: a window appears once, after
the watermark has passed its end; rows later than that are dropped by Spark and
counted beside the checkpoint. ``sinks.closing`` brings out what is open at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerlens.functions.expressions import risk_tier
from ledgerlens.streaming.sinks import FAR, batch_writer, places, run_each_batch

LABELS = ["endpoint", "model_version", "model_family", "status"]
RATE_WINDOW = "5 minutes"
RATE_SECONDS = 300
DELAY = "10 minutes"

# Upper bounds in seconds of the latency histogram, and alert-rate figures.
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]
ALERT_WINDOWS = ["15 minutes", "1 hour", "24 hours"]
ALERT_PANE = "15 minutes"
ALERT_PANE_SECONDS = 900
ALERT_SIZES = {"15 minutes": 900, "1 hour": 3600, "24 hours": 86400}
ALERT_REFERENCE_LOW = 0.0415
ALERT_REFERENCE_HIGH = 0.0495


def _edges(df: DataFrame, rest: list[Column | str]) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def _last(time: str) -> Column:
    """The row that closes a stream: it must reach the watermark whatever the filter."""
    return F.col(time) >= F.lit(FAR).cast("timestamp")


def request_rate(
    log: DataFrame, keys: list[str] | None = None, where: Column | None = None, delay: str = DELAY, time: str = "ts"
) -> DataFrame:
    """Requests per second in five-minute windows, by label."""
    keys = LABELS if keys is None else keys
    rows = log if where is None else log.where(where | _last(time))
    windows = rows.withWatermark(time, delay).groupBy(F.window(time, RATE_WINDOW), *keys)
    counted = windows.agg(F.count(F.lit(1)).alias("requests"))
    return _edges(counted, [*keys, "requests", (F.col("requests") / RATE_SECONDS).alias("per_second")])


def error_rate(log: DataFrame, delay: str = DELAY) -> DataFrame:
    return request_rate(log, ["endpoint", "model_version", "model_family"], F.col("status") == "error", delay)


def success_volume(log: DataFrame, delay: str = DELAY) -> DataFrame:
    return request_rate(log, ["model_version", "model_family"], F.col("status") == "success", delay)


def endpoint_status(log: DataFrame, endpoint: str, version: str, family: str, delay: str = DELAY) -> DataFrame:
    """Status split of one endpoint."""
    one = (F.col("endpoint") == endpoint) & (F.col("model_version") == version) & (F.col("model_family") == family)
    return request_rate(log, ["status"], one, delay)


def histogram_quantile(q: float, bounds: list[float], counts: list[Column], total: Column) -> Column:
    """Quantile from cumulative bucket counts, linear inside the bucket.

    Beyond the last bound the answer is the last bound; the first bucket starts at 0.
    """
    rank = F.lit(q) * total
    lower = [(0.0, F.lit(0)), *[(bound, count) for bound, count in zip(bounds, counts)]]
    result = F.when(total == 0, None)
    for (low, before), (high, upto) in pairwise(lower):
        inside = F.lit(low) + F.lit(high - low) * (rank - before) / (upto - before)
        result = result.when(upto >= rank, inside)
    return result.otherwise(F.lit(bounds[-1]))


def latency_quantiles(
    log: DataFrame,
    keys: list[str] | None = None,
    latency_ms: str = "latency_ms",
    delay: str = DELAY,
    time: str = "ts",
) -> DataFrame:
    """p50, p95 and p99 in seconds from a fixed histogram, five-minute windows.

    The state per window is one counter per bucket, whatever the traffic.
    """
    keys = LABELS if keys is None else keys
    seconds = F.col(latency_ms) / 1000
    counted = (
        log.withWatermark(time, delay)
        .groupBy(F.window(time, RATE_WINDOW), *keys)
        .agg(
            *[F.count_if(seconds <= bound).alias(f"_le{i}") for i, bound in enumerate(LATENCY_BOUNDS)],
            F.count(latency_ms).alias("requests"),
        )
    )
    counts = [F.col(f"_le{i}") for i in range(len(LATENCY_BOUNDS))]
    points = {
        name: histogram_quantile(q, LATENCY_BOUNDS, counts, F.col("requests"))
        for name, q in (("p50", 0.50), ("p95", 0.95), ("p99", 0.99))
    }
    return _edges(counted, [*keys, "requests", *[c.alias(n) for n, c in points.items()]])


def alert_level(rate: Column, warn_above: float, critical_above: float, low_below: float) -> Column:
    return (
        F.when(rate > critical_above, "critical")
        .when(rate > warn_above, "warning")
        .when(rate < low_below, "drop")
        .otherwise("expected")
    )


def rolling_alert_rate(
    log: DataFrame,
    size: str,
    pane: str = ALERT_PANE,
    delay: str = DELAY,
    time: str = "ts",
    *,
    warn_above: float = ALERT_REFERENCE_HIGH,
    critical_above: float = 2 * ALERT_REFERENCE_HIGH,
    low_below: float = ALERT_REFERENCE_LOW / 2,
) -> DataFrame:
    """Alert rate over sliding windows of ``size``, moving by one pane.

    Rows are counted into panes first and the long window adds up panes, so a
    24-hour window does not copy every row 96 times. Warning levels are
    parameters; the defaults start from the two reference rates.
    """
    panes = (
        log.where((F.col("status") == "success") | _last(time))
        .withWatermark(time, delay)
        .groupBy(F.window(time, pane))
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("fraud_prediction").alias("_alerts"))
    )
    summed = panes.groupBy(F.window(F.window_time("window"), size, pane)).agg(
        F.sum("_n").alias("requests"), F.sum("_alerts").alias("alerts")
    )
    rate = F.col("alerts") / F.col("requests")
    level = alert_level(rate, warn_above, critical_above, low_below)
    measures = ["requests", "alerts", rate.alias("alert_rate"), level.alias("level")]
    return _edges(summed, [F.lit(size).alias("size"), *measures])


class AlertWindows(StatefulProcessor):
    """Panes (start, requests, alerts) of one window size to the windows that hold them, each when its end has passed.

    State of a size: its open windows, as many as it has panes and those of one batch.
    """

    def __init__(self, pane_seconds: int):
        self.pane = pane_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", "starts array<bigint>, requests array<bigint>, alerts array<bigint>")

    def _closed(self, key, open_windows: dict[int, tuple[int, int]], watermark_ms: int) -> Iterator[Row]:
        """Rows of the windows that have ended; the others are kept, with a timer for the next end."""
        size, seconds = key
        ended = sorted(s for s in open_windows if (s + seconds) * 1000 <= watermark_ms)
        rows = [Row(size=size, start=s, end=s + seconds, requests=open_windows[s][0], alerts=open_windows[s][1]) for s in ended]
        for s in ended:
            del open_windows[s]
        starts = sorted(open_windows)
        self.state.update((starts, [open_windows[s][0] for s in starts], [open_windows[s][1] for s in starts]))
        if starts:
            self.handle.registerTimer((starts[0] + seconds) * 1000)
        return iter(rows)

    def _open(self) -> dict[int, tuple[int, int]]:
        starts, requests, alerts = self.state.get() or ((), (), ())
        return {s: (n, a) for s, n, a in zip(starts, requests, alerts, strict=True)}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        windows = self._open()
        for row in rows:
            for start in range(row["pane"] + self.pane - key[1], row["pane"] + self.pane, self.pane):
                requests, alerts = windows.get(start, (0, 0))
                windows[start] = (requests + row["requests"], alerts + (row["alerts"] or 0))
        return self._closed(key, windows, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._closed(key, self._open(), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def rolling_alert_rates(
    log: DataFrame,
    sizes: dict[str, int] | None = None,
    pane_seconds: int = ALERT_PANE_SECONDS,
    delay: str = DELAY,
    time: str = "ts",
    *,
    warn_above: float = ALERT_REFERENCE_HIGH,
    critical_above: float = 2 * ALERT_REFERENCE_HIGH,
    low_below: float = ALERT_REFERENCE_LOW / 2,
) -> DataFrame:
    """``rolling_alert_rate`` of all sizes (name -> seconds, each a multiple of the pane) in one pass over the log.

    The panes of the one aggregation go to every size's open windows, which lie in keyed state until the watermark has
    passed their end. To be started with the state in RocksDB (``sinks.rocksdb``).
    """
    sizes = sizes or ALERT_SIZES
    panes = (
        log.where((F.col("status") == "success") | _last(time))
        .withWatermark(time, delay)
        .groupBy(F.window(time, f"{pane_seconds} seconds"))
        .agg(F.count(F.lit(1)).alias("requests"), F.sum("fraud_prediction").cast("bigint").alias("alerts"))
    )
    named = F.array(*[F.struct(F.lit(n).alias("size"), F.lit(s).cast("bigint").alias("seconds")) for n, s in sizes.items()])
    each = panes.select("window", F.unix_seconds("window.start").alias("pane"), "requests", "alerts", F.explode(named).alias("s"))
    keyed = each.select("window", "pane", "requests", "alerts", "s.size", "s.seconds").groupBy("size", "seconds")
    schema = "size string, start bigint, end bigint, requests bigint, alerts bigint"
    windows = keyed.transformWithState(AlertWindows(pane_seconds), schema, "Append", "EventTime")
    rate = F.col("alerts") / F.col("requests")
    return windows.select(
        F.timestamp_seconds("start").alias("window_start"),
        F.timestamp_seconds("end").alias("window_end"),
        "size",
        "requests",
        "alerts",
        rate.alias("alert_rate"),
        alert_level(rate, warn_above, critical_above, low_below).alias("level"),
    )


def stream_risk_tiers(
    scored: DataFrame, score: str = "score", path: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Running count per tier (three rows of state); the newest batch of the table holds the totals."""
    spark = scored.sparkSession
    path, checkpoint = places(spark, "risk-tiers", path, checkpoint)
    tiers = scored.groupBy(risk_tier(score).alias("tier")).agg(F.count(F.lit(1)).alias("rows"))
    run_each_batch(tiers, batch_writer(path), checkpoint, mode="complete")
    table = spark.read.schema("tier string, rows bigint, batch_id bigint").parquet(path)
    newest = table.agg(F.max("batch_id")).first()[0]
    return table.where(F.col("batch_id") == F.lit(newest)).drop("batch_id")
