from __future__ import annotations

import __spark_entry__
from conftest import SF_DIR
from pitlane.session import SMALL_SPLIT, SPLIT_BYTES


def test_medallion_jobs_read_small_splits_and_others_the_sessions_own(spark):
    """Widened documents of a split of the default size do not fit a task's memory, so their sort spills nearly all."""
    queries, own = __spark_entry__.queries(), spark.sparkContext.getConf().get(SPLIT_BYTES, None)
    documents = queries["silver_parts"](spark, SF_DIR)
    assert spark.conf.get(SPLIT_BYTES) == SMALL_SPLIT and documents.count() > 0
    queries["op4_slot_sharding"](spark, SF_DIR)
    assert spark.conf.get(SPLIT_BYTES) == (own or "134217728b")
    queries["mart_market_pricing"](spark, SF_DIR)
    assert spark.conf.get(SPLIT_BYTES) == SMALL_SPLIT
