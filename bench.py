"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores,
``BENCH_QUERIES`` an optional comma-separated choice (``all`` for every registered one).
Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts. The
result goes to the ``noop`` sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark.queries import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "revenue_by_category_star",
    "revenue_by_category_oltp",
    "revenue_by_city_category_star",
    "revenue_by_city_category_oltp",
    "daily_revenue_star",
    "daily_revenue_oltp",
    "revenue_by_city",
    "fanout_wrong_revenue",
    "scalar_subquery_totals",
    "fanout_lines_per_order",
    "fact_sales",
    "dim_customer",
    "dim_product",
    "dim_date",
    "publish_star",
    "scd1_latest",
    "scd1_upsert",
    "scd2_merge",
    "scd2_stored_refresh",
    "scd3_merge",
    "cdc_incremental",
    "cdc_current_state",
    "cdc_end_to_end",
    "latest_per_key",
    "having_dup_grain",
    "dq_orphans",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = sorted(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in names:
        once(name)
        timings[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, median per query",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
