"""Headline queries, timed: prints one JSON line.

Landed inputs are produced before the clock starts. Every query is run to its last row (``noop`` sink): one
warm-up, then the median of ``BENCH_RUNS`` (3).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from tributary.plans.landing import land
from tributary.plans.queries import QUERIES
from tributary.session import prepare

HEADLINE = (
    "sql_date_range_join", "sql_group_agg", "sql_order_limit", "sql_result_pages", "resolve_details", "record_flatten",
    "record_child_rows", "multi_table_write", "column_types_widen", "strip_links", "dotted_path_rows", "page_gaps",
    "page_completeness", "upsert_pk", "upsert_table", "key_duplicates", "csv_roundtrip", "filter_date",
    "relative_ranges", "search_xml_rows", "redact_email", "redact_keys",
)
LANDED = ("documents", "collection", "sql_pages", "event_pages", "wrapped_pages", "search_xml")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    for name in LANDED:
        land(spark, sf_dir, name)
    times = {}
    for name in HEADLINE:
        seconds = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
