"""Wall seconds of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.catalog import registry  # noqa: E402
from ledgerlens.session import build_session, discard  # noqa: E402

HEADLINE = [
    "entity_risk_metrics",
    "enrich_identity",
    "frequency_encode",
    "uid_stats_fit",
    "uid_stats_apply",
    "uid_time_gaps",
    "past_history_features",
    "past_history_median",
    "rolling_history",
    "split_by_time_ratio",
    "features_v1",
    "features_v2",
    "foundation_table",
    "behavioral_table",
    "batch_prepare",
    "numeric_audit",
    "categorical_audit",
    "missing_signal_strength",
    "drift_report",
    "latency_summary",
    "metrics_at_threshold",
    "threshold_table",
    "cost_curve",
    "best_policy",
    "top_fn_groups",
    "extract_request_fields",
    "route_requests",
    "parse_event_json",
    "stream_request_rate",
    "stream_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    }
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    known = registry.load()
    seconds = {}
    for key in [k for k in HEADLINE if k in known]:
        times = []
        for _ in range(runs + 1):  # the first run warms up
            start = time.perf_counter()
            known[key].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[key] = round(statistics.median(times[1:]), 3)
        discard(spark)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    line = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
