"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores. Every
query is run once to warm up and then three times into a no-op sink, which takes
all rows and columns; the median counts. ``value`` is the sum over the queries.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from checks.catalog import QUERIES

HEADLINE = [
    "time_parts",
    "index_exchange",
    "rolling_features",
    "trade_features",
    "bars_1m",
    "bars_1h",
    "latest_as_of",
    "enrich_day",
    "enrich_asof",
    "enrich_market",
    "trade_records",
    "valid_messages",
    "chunks",
    "latest_per_key",
    "completeness",
    "value_counts",
    "documents_typed",
    "landing_stream",
]


def run(spark, sf_dir, name):
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names):
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Recording the Python line of every column costs more than these small queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names or HEADLINE:
        run(spark, sf_dir, name)
        seconds[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(3)), 3)
    spark.stop()
    result = {
        "metric": "sum of median query seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main(sys.argv[1:])
