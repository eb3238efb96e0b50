from __future__ import annotations

import os

from pyspark.sql import functions as F

from pitlane.sources import bronze


def test_a_collection_is_computed_once_for_its_flat_table(spark, tmp_path):
    """Looking for a first document computed it once more, with all its shuffles."""
    root, seen = str(tmp_path), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    documents = spark.range(40, numPartitions=4).mapInArrow(counted, "id long").withColumn("_raw", F.lit("x"))
    assert bronze.bronze_write_parquet(documents, root, "docs")
    assert seen.value == 40
    assert spark.read.parquet(f"{root}/docs").columns == ["id"] and os.listdir(root) == ["docs"]


def test_an_empty_collection_leaves_the_older_table(spark, tmp_path):
    root = str(tmp_path)
    assert bronze.bronze_write_parquet(spark.range(3), root, "docs")
    assert not bronze.bronze_write_parquet(spark.range(3).where("id > 5"), root, "docs")
    assert spark.read.parquet(f"{root}/docs").count() == 3 and os.listdir(root) == ["docs"]
    assert bronze.bronze_write_parquet(spark.range(5), root, "docs")
    assert spark.read.parquet(f"{root}/docs").count() == 5 and os.listdir(root) == ["docs"]
