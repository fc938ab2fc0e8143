"""Time the layers and the headline queries; print one JSON line.

BENCH_SF_DIR   folder of parquet tables   (/root/testdata/sf0.1)
BENCH_CPUS     local threads              (8)
BENCH_RUNS     timed runs per query       (3), after one warm-up; the median counts
BENCH_QUERIES  comma-separated query names, or ``all``

Every query is run to its last row into the ``noop`` sink. Layer builds are
timed once and include writing; queries read the stored layers below them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from smelter.plans import build  # noqa: E402
from smelter.scratch import use_scratch  # noqa: E402
from smelter.specs import SOURCE_TABLES  # noqa: E402
from verification.queries import QUERIES, SCRATCH  # noqa: E402
from verification.warehouse import warehouse  # noqa: E402

HEADLINE = (
    "cdc_envelope_parse",
    "cdc_latest_delete_aware",
    "cdc_latest_composite",
    "cdc_stream_append",
    "insert_if_absent",
    "key_dense",
    "silver_orders",
    "silver_order_items",
    "silver_payments",
    "silver_reviews",
    "gold_dim_customer",
    "gold_dim_product",
    "gold_fact_order_items",
    "gold_fact_reviews",
    "q_revenue_by_region",
    "q_top_categories",
    "q_review_analysis",
    "q_filter_and",
    "dq_rules",
    "dq_duplicates",
    "dq_orphans",
)


def run_to_end(spark: SparkSession, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_scratch(spark, SCRATCH)

    stored = warehouse(spark, sf_dir)
    builds = {}
    for layer, read, tables in (
        ("build_bronze", stored.bronze, SOURCE_TABLES),
        ("build_silver", stored.silver, SOURCE_TABLES),
        ("build_gold", stored.gold, build.DIMENSIONS + build.FACTS),
    ):
        started = time.perf_counter()
        for table in tables:
            read(table)
        builds[layer] = round(time.perf_counter() - started, 3)

    seconds = {}
    for name in names:
        run_to_end(spark, sf_dir, name)
        seconds[name] = round(
            statistics.median(run_to_end(spark, sf_dir, name) for _ in range(runs)), 3
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "builds": builds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
