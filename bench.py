"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local
cores.  Each query is run once to warm up and then timed as the best of two
full executions into a sink that discards the rows.  The change log is derived
once, before any query that reads it is timed.
"""

from __future__ import annotations

import json
import os
import time

from ebbtide.session import builder
from ebbtide.suite import QUERIES, retail, streams

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))

HEADLINE = [
    "enriched_line_items",
    "revenue_by_category",
    "revenue_by_window",
    "pricing_anomalies",
    "orders_per_category",
    "abnormal_order_totals",
    "demand_spikes",
    "event_rates",
    "reference_report",
    "key_checks",
    "signed_line_items",
    "replayed_line_items",
    "current_line_items",
    "enriched_after_changes",
    "category_revenue_after_changes",
    "anomalies_after_changes",
    "windows_over_changes",
    "snapshot_diff",
    "reconciled_line_items",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    began = time.perf_counter()
    work()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    spark = (
        builder("bench", f"local[{CPUS}]", int(CPUS))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    setup = timed(lambda: retail.log(spark, SF_DIR).path)
    seconds = {}
    for name in HEADLINE:
        run(QUERIES[name](spark, SF_DIR))
        seconds[name] = min(timed(lambda: run(QUERIES[name](spark, SF_DIR))) for _ in range(2))
    # The continuous job, over the whole log, from an empty state.
    seconds["statement_set"] = timed(lambda: streams.finished_job(spark, SF_DIR))
    events = sum(retail.decoded(spark, SF_DIR, s).count() for s in (retail.LINES, retail.ORDERS, retail.PRODUCTS))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "change_log_setup_sec": setup,
                "change_events": events,
                "statement_set_events_per_sec": round(events / seconds["statement_set"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
