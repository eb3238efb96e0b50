"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query
runs once to warm up and ``BENCH_REPEATS`` times for its median; every row and
column is computed and dropped. Marts, staging and serving queries read silver
and the enriched catalogue as their warm-up run stored them, as a scheduled run
does. ``cold_…`` builds one mart from the base tables, with all it stores on the
way, in a warm session, once; ``medallion_end_to_end`` all four, likewise.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from pitlane.operators import marts
from pitlane.plans import registry
from pitlane.plans.lake import Lake
from pitlane.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

HEADLINE = [
    "silver_parts", "silver_recalls", "silver_listings", "silver_parts_local", "silver_listings_local",
    "int_price_stats", "int_source_coverage_multisource", "int_parts_enriched", "int_parts_enriched_multisource",
    "pricing_catalog_side", "pricing_market_side", "mart_market_pricing", "mart_market_pricing_local",
    "mart_catalog_coverage", "mart_catalog_coverage_local", "mart_supplier_performance",
    "mart_supplier_performance_local", "mart_recall_impact", "seller_market_perf", "dq_report",
    "ingest_upsert", "ingest_feed_listings", "ingest_stream_upsert", "parts_compatibility_build",
    "recall_normalize", "bronze_export_json", "silver_write_partitioned", "kpi_overview", "top_categories",
]


def _consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


COLD = {
    "mart_market_pricing": lambda lake: marts.mart_market_pricing(lake.enriched(), lake.stg_listings()),
    "mart_catalog_coverage": lambda lake: marts.mart_catalog_coverage(lake.stg_listings(), lake.stg_recalls()),
    "mart_supplier_performance": lambda lake: marts.mart_supplier_performance(lake.enriched()),
    "mart_recall_impact": lambda lake: marts.mart_recall_impact(lake.stg_recalls(), lake.stg_listings()),
}


def _cold(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    _consume(COLD[name](Lake(spark, SF_DIR)))
    return round(time.perf_counter() - start, 3)


def _end_to_end(spark: SparkSession) -> None:
    lake = Lake(spark, SF_DIR)
    listings, recalls = lake.stg_listings(), lake.stg_recalls()
    for mart in (
        marts.mart_market_pricing(lake.enriched(), listings),
        marts.mart_catalog_coverage(listings, recalls),
        marts.mart_supplier_performance(lake.enriched()),
        marts.mart_recall_impact(recalls, listings),
    ):
        _consume(mart)


def _timed(run: Callable[[], None]) -> float:
    run()
    seconds = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    spark = build_session("pitlane-bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": str(CPUS),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "12g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    lake = Lake.of(spark, SF_DIR)
    names = sys.argv[1:] or HEADLINE
    seconds = {name: _timed(lambda n=name: _consume(registry.QUERIES[n](lake))) for name in names}
    if not sys.argv[1:]:
        seconds |= {f"cold_{name}": _cold(spark, name) for name in COLD}
        seconds["medallion_end_to_end"] = _timed(lambda: _end_to_end(spark))
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(SF_DIR).name.removeprefix("sf"), "cpus": CPUS, "repeats": REPEATS,
    }))


if __name__ == "__main__":
    main()
