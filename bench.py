"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ticketlake.queries import REGISTRY  # noqa: E402
from ticketlake.session import build_session  # noqa: E402

HEADLINE = [
    "daily_summary",
    "daily_summary_all_days",
    "session_summary",
    "project_total",
    "action_performance",
    "order_grain_breakdown",
    "daily_matrix",
    "session_daily_pivot",
    "distributor_breakdown",
    "campaign_performance",
    "inventory_reconcile_tier",
    "tuple_sell_through",
    "exact_lookup",
    "interval_lookup_last_wins",
    "revenue_rule_range",
    "patch_overlay",
    "prefix_attribution",
    "direct_sales",
    "market_sales",
    "distributor_sales",
    "channel_standard_orders",
    "channel_block_report",
    "channel_section_report",
    "weekly_content_metrics",
    "weekly_cross_platform_report",
    "locf_fill",
    "block_assign",
    "stream_daily_revenue",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    for name in only:
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name} {best:.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
