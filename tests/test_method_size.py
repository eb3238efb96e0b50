from __future__ import annotations

import __spark_entry__
from conftest import SF_DIR
from pitlane.session import METHOD_BYTES


def test_documents_are_cleaned_by_methods_the_jvm_compiles(spark):
    """The JVM interprets methods above 8,000 bytes: cleaning the catalogue took three times as long."""
    queries, own = __spark_entry__.queries(), spark.sparkContext.getConf().get(METHOD_BYTES, None)
    assert queries["silver_parts"](spark, SF_DIR).count() > 0
    assert int(spark.conf.get(METHOD_BYTES)) <= 8000
    queries["op4_slot_sharding"](spark, SF_DIR)
    assert spark.conf.get(METHOD_BYTES) == (own or "65535")
