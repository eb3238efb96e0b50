"""Sharding by fixed virtual slots and a versioned map from slots to shards.

Records are hashed into ``SLOTS`` virtual slots, bytes and rows are summed per
slot, and a map of ``SLOTS`` rows says which shard a slot belongs to. Version 1
deals slots out in turn; version 2 is edited so that all shards hold nearly the
same bytes, leaving a slot at home where it fits. A new shard is filled by
``grown``, the next version, which moves slots into that shard only.

Only the map, of fixed size, is handled in one row or broadcast. Documents are
shuffled once, as numbers, by virtual slot, to number them inside their shard.

A record's slot hangs on its id and text. Only records that are repeated are
also told apart by their place in the stored table of records, so one record in
a third of all rows fills all slots alike; which of equal rows lies where is the
same within a run, and has no meaning.

Nulls: a null text has size 1 and the checksum of the empty text; a null
``doc_id`` is hashed as such. Other columns are not read. An empty table gives
an empty result and a map of empty slots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitlane.sources import shared

SLOTS = 4096


def placed(documents: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot``."""
    records = shared.store(documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id", "text").alias("record"), F.monotonically_increasing_id().alias("place"),
    ), "records")
    repeated = shared.store(
        records.groupBy("record").agg(F.count("*").alias("times")).filter("times > 1").select("record", F.lit(True).alias("again")),
        "repeated_records",
    )
    spread = F.when(F.col("again"), F.xxhash64("record", "place")).otherwise(F.col("record"))
    return records.join(repeated, "record", "left").select(
        "doc_id", "size", "text_crc32", F.pmod(spread, F.lit(SLOTS)).cast("int").alias("virtual_slot")
    )


def slot_sizes(records: DataFrame) -> DataFrame:
    """``virtual_slot, slot_bytes, slot_rows`` of all slots, empty ones included: always ``SLOTS`` rows."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows"))
    every = records.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(sums, "virtual_slot", "left").select(
        "virtual_slot", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("slot_bytes", "slot_rows"))
    )


def first_map(sizes: DataFrame, shards: int) -> DataFrame:
    """Version 1: slots in turn, whatever they hold."""
    return sizes.withColumn("shard", F.pmod("virtual_slot", F.lit(shards)).cast("int")).withColumn("version", F.lit(1))


def rebalanced(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version: the largest slots first, each at home if that stays below the mean, else where least is.

    The fold runs over one row of ``SLOTS`` entries.
    """
    listed = slot_map.groupBy().agg(
        F.sort_array(F.collect_list(F.struct("slot_bytes", "virtual_slot", "shard", "slot_rows")), asc=False).alias("s"),
        F.ceil(F.sum("slot_bytes") / shards).alias("mean"),
        F.max("version").alias("version"),
    )
    empty = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), shards).alias("loads"),
        F.array().cast("array<int>").alias("chosen"),
    )

    def place(acc, slot):
        at_home = acc["loads"][slot["shard"]] + slot["slot_bytes"] <= F.col("mean")
        least = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        to = F.when(at_home, slot["shard"]).otherwise(least)
        return F.struct(
            F.transform(acc["loads"], lambda x, i: x + F.when(i == to, slot["slot_bytes"]).otherwise(0)).alias("loads"),
            F.concat(acc["chosen"], F.array(to)).alias("chosen"),
        )

    folded = listed.withColumn("chosen", F.aggregate("s", empty, place, lambda acc: acc["chosen"]))
    return folded.select("version", F.explode(F.arrays_zip("s", "chosen")).alias("x")).select(
        "x.s.virtual_slot", "x.s.slot_bytes", "x.s.slot_rows",
        F.col("x.chosen").alias("shard"), (F.col("version") + 1).alias("version"),
    )


def grown(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version for one more shard: each shard gives slots up to what it has above the new mean."""
    total = slot_map.agg(F.sum("slot_bytes").alias("total"))
    by_size = Window.partitionBy("shard").orderBy("slot_bytes", "virtual_slot")
    given = F.sum("slot_bytes").over(by_size.rowsBetween(Window.unboundedPreceding, 0))
    load = F.sum("slot_bytes").over(Window.partitionBy("shard"))
    return slot_map.join(F.broadcast(total)).withColumns({"given": given, "load": load}).select(
        "virtual_slot", "slot_bytes", "slot_rows",
        F.when(F.col("given") <= F.col("load") - F.col("total") / (shards + 1), shards)
        .otherwise(F.col("shard")).cast("int").alias("shard"),
        (F.col("version") + 1).alias("version"),
    )


def store_version(slot_map: DataFrame, folder: str) -> None:
    """Add a version to the stored maps; a version is written once and never changed."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(folder)


def stored_version(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """One version of the map, the newest by default."""
    maps = spark.read.parquet(folder)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == version)


def sharded(documents: DataFrame, shards: int = 8, folder: str | None = None) -> DataFrame:
    """One row per document, by the law of nearly equal bytes.

    ``shard, slot`` name a record's place: ``slot`` numbers a shard's records
    from 0 without gaps. The map is stored in ``folder``, by default one in the
    shared folder, as versions 1 and 2; the newest one counts.
    """
    spark = documents.sparkSession
    folder = folder or shared.new_path(spark, "slot_map")
    records = placed(documents)
    first = shared.store(first_map(slot_sizes(records), shards), "slot_sizes")
    store_version(first, folder)
    store_version(rebalanced(first, shards), folder)
    before = F.sum("slot_rows").over(
        Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    current = stored_version(spark, folder).select(
        "virtual_slot", "shard", F.coalesce(before, F.lit(0)).alias("before")
    )
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = records.withColumn("nth", F.row_number().over(in_slot) - 1)
    return numbered.join(F.broadcast(current), "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("nth")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
