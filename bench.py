"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; the median counts. Building the
query is timed too, because some operators settle intermediate results while building.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from energy_mart.checks import catalogue
from energy_mart.session import build_session

HEADLINE = (
    "p15_swap_zero_null", "p18_split_token", "p26_display_format", "f3_clean_prices",
    "j1_wide_left_join", "a2_total_reconciliation", "a6_company_month_matrix", "a8_period_change",
    "a14_monthly_series", "a16_describe", "a17_correlations_pairwise", "a19_outlier_summary",
    "a27_histogram", "a31_market_share", "q1_dataset_metrics", "q5_distinct_counts",
    "q8_duplicated_rows", "q10_reject_split", "s5_climate_payload", "w9_fact_tariff",
    "w11_fact_fuels", "v2_monthly_income", "g2_zone_boxes",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    if os.environ.get("BENCH_ALL"):
        names = list(catalogue.queries())
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known, seconds = catalogue.queries(), {}
    for name in names:
        taken = []
        for turn in range(runs + 1):
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if turn:
                taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus), "runs": runs, "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
