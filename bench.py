"""Time the headline queries: one warm-up, then the median of the runs, written to a noop sink.

Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS, BENCH_QUERIES (comma separated, "all" for
every registered query).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lotwise.session import build_session  # noqa: E402
from registry import QUERIES  # noqa: E402

HEADLINE = [
    "dense_brand_spine", "brand_segment_monthly", "inventory_vs_sales_pivot", "plan_by_model", "plan_rollup_capped",
    "used_inventory", "used_sales_by_unit", "price_runs", "price_changes", "price_deltas", "prefer_source_dedupe",
    "period_interval_join", "discount_measures", "strategy_stack", "trades_by_month", "speed_bands_distinct",
    "duration_components", "brand_tracker", "portfolio_stack", "portfolio_pivot", "availability",
    "electric_availability", "market_share_monthly", "market_share_ytd", "industry_tags", "record_match",
    "lead_acquisition_stack", "distance_bands", "rule_table_mapping", "history_backfill", "roll_history",
    "replace_period", "question_answers", "page_records", "keyword_lines", "file_combine",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session("lotwise-bench", cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    results = {}
    for name in names:
        timings = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        results[name] = round(statistics.median(timings[1:]), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(f"{name} cold {timings[0]:.2f} warm {results[name]:.2f}", file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "total warm seconds of the headline queries", "value": round(sum(results.values()), 3), "unit": "sec",
        "queries": results, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
