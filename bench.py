"""Times the headline queries and prints one JSON line, with the megabytes each run shuffles.

Arguments name other queries; ``heavy`` stands for those of ``HEAVY``.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
BENCH_RUNS    timed runs per query after one warm-up; the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from vitrina.plans.registry import QUERIES

HEADLINE = [
    "fact_sales",
    "dim_customer_rfm",
    "cube_n1",
    "cube_n2",
    "cube_n4",
    "cube_grouping_sets",
    "olap_rollup",
    "olap_slice",
    "olap_dice",
    "olap_pivot",
    "kpi_totals",
    "kpi_yoy",
    "kpi_margin",
    "dash_top_products",
    "rfm_as_of",
    "scd2_product",
    "scd2_customer",
    "promo_interval_join",
    "churn_features",
    "product_profile",
    "naive_bayes_predict",
    "weekly_sales",
    "seasonal_decompose",
    "category_correlation",
    "baskets",
    "frequent_itemsets",
    "association_rules",
]


# Long ones, which are timed on demand.
HEAVY = ["star_join", "stored_star_join", "kpi_summary", "cube_reconcile", "load_warehouse", "kmeans_elbow", "churn_forest", "churn_cv"]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vitrina-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus != "*" else str(os.cpu_count()))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Call sites of every column expression cost more than planning these queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def shuffled(spark: SparkSession) -> float:
    """Megabytes written to shuffles since the session began."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size())) / 1e6


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "*"))
    names = [n for given in sys.argv[1:] for n in (HEAVY if given == "heavy" else [given])] or HEADLINE
    seconds, moved = {}, {}
    for name in names:
        before = shuffled(spark)
        run(spark, name, folder)
        moved[name] = round(shuffled(spark) - before, 1)
        seconds[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "shuffle_mb": moved,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
