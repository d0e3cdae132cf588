"""Look for operators that do not scale in the plan of every query: python tools/check_plans.py [sf_dir]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

SUSPECTS = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "Generate"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from ledgerlens.catalog import registry
    from ledgerlens.session import build_session

    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.maxPlanStringLength": "10000000",
    }
    spark = build_session("plans", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[2:]
    for key, query in registry.load().items():
        if wanted and key not in wanted:
            continue
        df = query.run(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = [s for s in SUSPECTS if s in plan]
        single = "Exchange SinglePartition" in plan
        lines = plan.split("\n")
        scans = sum("FileScan" in line for line in lines)
        exchanges = sum("Exchange hashpartitioning" in line for line in lines)
        window = any("Window" in line and "SinglePartition" in nxt for line, nxt in zip(lines, lines[2:]))
        print(f"{key}: scans {scans} exchanges {exchanges} single {single} window-on-one {window} {found or ''}", flush=True)


if __name__ == "__main__":
    main()
