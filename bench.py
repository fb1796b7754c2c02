"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the cores. Each query
is planned and run to a no-op sink; one untimed run warms it up.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "bridge_calls_to_market",
    "bridge_dispositions",
    "stage_payments",
    "stage_agents",
    "dedupe_lineitem_by_key",
    "flag_repeated_lineitem_keys",
    "digit_run_candidates",
    "code_calls",
    "nearest_click_before_purchase",
    "nearest_order_by_status",
    "orders_in_window_by_status",
    "candidate_calls_in_window",
    "attribute_payments",
    "payment_summary",
    "coding_rate",
    "paid_post_call",
    "inbound_drivers",
    "daily_summary",
    "market_paid",
    "kpi_totals",
    "drill_levels",
    "fx_resolve",
    "check_suite",
    "check_unique_combination",
    "load_plan",
]


def main() -> None:
    from callpay.session import build_session
    from catalogue.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 8)
    spark = build_session("bench", f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(run(name), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("/", 1)[-1].removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
