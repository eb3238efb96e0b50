from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from pitlane.sources import starmap


@pytest.mark.parametrize("collection, key", [("market_listings", "listing_id"), ("vehicle_recalls", "recall_id")])
def test_documents_of_one_id_meet_in_one_task(spark, collection, key):
    """Without broadcasts, as with large tables, the deduplication can leave one of them before it shuffles any."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    own = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        raw = starmap.RAW[collection](spark, SF_DIR).select(key, F.spark_partition_id().alias("task"))
        spread = raw.groupBy(key).agg(F.countDistinct("task").alias("tasks"), F.count(F.lit(1)).alias("n")).collect()
    finally:
        for name, value in own.items():
            spark.conf.set(name, value)
    assert max(r["n"] for r in spread) > 1
    assert max(r["tasks"] for r in spread) == 1
