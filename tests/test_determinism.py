"""Results do not depend on the number of partitions or the order of the input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pitlane.operators import enrich, marts, merge, silver, staging


def _pricing(lake, shuffled):
    parts, listings = (shuffled(lake.raw(c)) for c in ("parts_catalog", "market_listings"))
    enriched = enrich.int_parts_enriched(staging.stg_parts(silver.silver_parts(parts)))
    return marts.mart_market_pricing(enriched, staging.stg_listings(silver.silver_listings(listings)))


def _recalls(lake, shuffled):
    return silver.silver_recalls(shuffled(lake.raw("vehicle_recalls")))


def _suppliers(lake, shuffled):
    catalog = staging.stg_parts(silver.silver_parts(shuffled(lake.raw("parts_catalog"))))
    return marts.mart_supplier_performance(enrich.int_parts_enriched(catalog))


def _merged(lake, shuffled):
    batch = shuffled(lake.documents("market_listings"))
    return merge.ingest_upsert(merge.empty_target(batch), batch, "listing_id", F.lit("2024-01-01").cast("timestamp"))


@pytest.mark.parametrize("build", [_pricing, _recalls, _suppliers, _merged])
def test_same_rows(spark, lake, build):
    ways = [
        ("1", lambda df: df.coalesce(1)),
        ("13", lambda df: df.repartition(7)),
        ("4", lambda df: df.orderBy(F.xxhash64(F.col(df.columns[0])))),
    ]
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, shuffled in ways:
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            results.append(sorted(map(repr, build(lake, shuffled).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2] and results[0]
