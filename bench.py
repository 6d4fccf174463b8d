"""Time the mart build and the headline queries; prints one JSON line.

The build and each query are run once to warm up and then timed; a query's result goes to
Spark's no-op sink. The build runs from landing the sources to the written fact.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

from vigilmart import settings
from vigilmart.plans.build import build
from vigilmart.plans.catalog import QUERIES, built, land_sources
from vigilmart.sources.adapters import FIRST_SNAPSHOT
from vigilmart.sources.workspace import new_folder

HEADLINE = (
    "silver_transactions",
    "customer_src",
    "dedup_latest",
    "scd2_apply",
    "dim_account",
    "fact_transaction",
    "fact_point_in_time",
    "ctr_candidates",
    "structuring_flags",
    "sanctions_hits",
    "sanctions_fuzzy",
    "row_access",
    "ctr_region_scoped",
    "ctr_by_customer_key",
    "classified_columns",
    "dq_scorecard",
    "kpi_summary",
    "kpi_branch_breakdown",
    "kpi_volume_trend",
    "stream_bronze",
    "stream_dedup",
    "stream_scd2",
    "stream_ctr",
)


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vigilmart-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = settings.tuned(builder, shuffle_partitions=int(cpus)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def rebuild() -> None:
        build(spark, land_sources(spark, sf_dir), new_folder(spark, "mart"), FIRST_SNAPSHOT, on_fail="report")

    built(spark, sf_dir)
    seconds = {"mart_build": timed(rebuild)}
    for name in sys.argv[1:] or HEADLINE:

        def run(query=QUERIES[name]) -> None:
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = timed(run)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
