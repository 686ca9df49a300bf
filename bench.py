"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   data folder, default /root/testdata/sf0.1
BENCH_CPUS     local cores, default all
BENCH_RUNS     timed runs per query after one warm-up, default 3; the median counts
BENCH_QUERIES  space-separated names, default the headline queries
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

import query_set  # noqa: E402
from basketry.session import configure  # noqa: E402

HEADLINE = (
    "stg_orders dim_customers dim_products fact_orders mart_sales_overview mart_customer_ltv "
    "mart_product_performance sales_by_country top_customers check_report latest_snapshot load_csv_order_items "
    "gen_orders pipeline_end_to_end"
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", HEADLINE).split()
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.ui.enabled", "false")
    builder = builder.config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
    spark = configure(builder, cores=cpus).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            query_set.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(name, seconds[name], [round(t, 2) for t in times], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total median query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
