"""Time the registered queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from parcelmetrics.queries import QUERIES, case_rows, parent_rows, shipment_rows, suite_rows
from parcelmetrics.sources.sample import sample_tables


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("parcelmetrics-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    timings: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        timings[name] = round(time.perf_counter() - start, 3)

    # Written inputs are timed as entries of their own.
    timed("write_sample_tables", lambda: list(sample_tables(spark, sf_dir).values()))
    timed("write_case_rows", lambda: case_rows(spark, sf_dir))
    timed("write_parent_rows", lambda: parent_rows(spark, sf_dir))
    timed("write_shipment_rows", lambda: shipment_rows(spark, sf_dir))
    timed("write_suite_rows", lambda: suite_rows(spark, sf_dir))
    timed("write_suite_rows_by_year", lambda: suite_rows(spark, sf_dir, by_year=True))
    for name, query in QUERIES.items():
        if not only or name in only:
            timed(name, lambda q=query: q(spark, sf_dir).write.format("noop").mode("overwrite").save())
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
