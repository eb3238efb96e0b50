"""Incremental ingest: documents stream into a log, the table is the log's latest state.

Each micro-batch costs what it carries; nothing already stored is rewritten. The
file sink commits a batch once, also after a restart from its checkpoint. The
state is one aggregation combined before its shuffle, so neither a long log nor
a key with very many versions gathers in one task.

Each run appends under a load of its own, a folder of the log. ``compact`` folds
all loads so far into a snapshot beside the log; the state is then the snapshot
and the loads after it. The log itself and the stream's checkpoint are left
alone, so the stream goes on as if nothing had happened. Folding keeps the age
of each field, so the state is the same with and without it.

Where documents name the fields they sent (``_present``), a field's value is
that of the newest document that sent it.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pitlane import schemas as S
from pitlane.operators.merge import AGES, FIRST_SEEN, sent, usable_key
from pitlane.sources import bronze, tables

# Landing files keep microseconds; the JSON writer's default cuts them.
TIMESTAMPS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


LOAD = "_load"


def read_feed(
    spark: SparkSession, landing: str, schema: T.StructType, batch_bytes: int = 64 * 2**30, format: str = "json",
    by_field: bool = False,
) -> DataFrame:
    """Documents landing as files, in micro-batches of a bounded size; ``by_field`` tells which fields they sent."""
    if by_field:
        lines = spark.readStream.option("maxBytesPerTrigger", batch_bytes).text(landing)
        return bronze.parsed_lines(lines.where(F.trim("value") != ""), schema).drop(S.CORRUPT)
    return spark.readStream.format(format).schema(schema).option("maxBytesPerTrigger", batch_bytes).load(landing)


def ingest_stream_upsert(
    feed: DataFrame, log: str, checkpoint: str, id_field: str, seen_at: Column | None = None, load: str | None = None
) -> StreamingQuery:
    """Append all waiting documents with a usable key to ``log``, then stop.

    ``load`` names the run; later runs need greater names. By default it is the time.
    """
    seen = F.current_timestamp() if seen_at is None else seen_at
    name = load or datetime.now(timezone.utc).strftime("t%Y%m%d%H%M%S%f")
    return (
        feed.where(usable_key(feed, id_field))
        .withColumns({FIRST_SEEN: seen, LOAD: F.lit(name)})
        .writeStream.format("parquet")
        .partitionBy(LOAD)
        .option("path", log)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_state(log: DataFrame, id_field: str, newest: str = "ingested_at") -> DataFrame:
    """Latest version of every key with the earliest time it was seen."""
    if S.PRESENT in log.columns:
        return folded(log, id_field, newest).drop(S.PRESENT, AGES)
    log = log.drop(LOAD)
    fields = [c for c in log.columns if c not in (id_field, FIRST_SEEN)]
    rank = F.struct(newest, *[c for c in fields if c != newest])
    latest = log.groupBy(id_field).agg(
        F.max_by(F.struct(*fields), rank).alias("_latest"), F.min(FIRST_SEEN).alias(FIRST_SEEN)
    )
    return latest.select(id_field, *[F.col(f"_latest.{c}").alias(c) for c in fields], FIRST_SEEN)


def folded(log: DataFrame, id_field: str, newest: str = "ingested_at") -> DataFrame:
    """One row per key that stands for all its rows: values, the fields ever sent, and the age of each.

    Folding what is folded already, with or without newer rows, gives the same
    as folding everything at once.
    """
    fields = [c for c in log.columns if c not in (id_field, newest, FIRST_SEEN, LOAD, S.PRESENT, AGES)]
    aged = AGES in log.columns

    def age(c: str) -> Column:
        own = F.coalesce(F.col(AGES)[c], F.col(newest)) if aged else F.col(newest)
        return F.when(sent(c), own)

    state = log.groupBy(id_field).agg(
        *[F.max_by(c, F.when(sent(c), F.struct(age(c), F.col(c)))).alias(c) for c in fields],
        F.max(newest).alias(newest), F.min(FIRST_SEEN).alias(FIRST_SEEN),
        F.array_distinct(F.flatten(F.collect_set(S.PRESENT))).alias(S.PRESENT),
        F.struct(*[F.max(age(c)).alias(c) for c in fields]).alias("_age"),
    )
    ages = F.map_from_arrays(
        F.array(*[F.lit(c) for c in fields]), F.array(*[F.col(f"_age.{c}") for c in fields])
    )
    return state.withColumn(AGES, ages).drop("_age")


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """The log with the fields of all its files, and names of loads as they were given (``01`` is not ``1``)."""
    found = spark.read.option("mergeSchema", "true").parquet(log).schema
    return spark.read.schema(
        T.StructType([T.StructField(f.name, T.StringType()) if f.name == LOAD else f for f in found])
    ).parquet(log)


def _whole(log: DataFrame, id_field: str) -> DataFrame:
    """Rows that do not tell which fields they sent have sent all."""
    everything = F.array(*[F.lit(c) for c in log.columns if c not in (FIRST_SEEN, LOAD, S.PRESENT)])
    return log.withColumn(S.PRESENT, F.coalesce(S.PRESENT, everything) if S.PRESENT in log.columns else everything)


def current(spark: SparkSession, log: str, snapshots: str, id_field: str, newest: str = "ingested_at") -> DataFrame:
    """The state from the newest snapshot and the loads after it."""
    return _current(spark, log, snapshots, id_field, newest).drop(S.PRESENT, AGES)


def _current(spark: SparkSession, log: str, snapshots: str, id_field: str, newest: str) -> DataFrame:
    rows = _whole(read_log(spark, log), id_field)
    kept = tables.latest_version(spark, snapshots)
    if kept is None:
        return folded(rows.drop(LOAD), id_field, newest)
    until = kept.select("_until").first()
    later = rows.where(F.col(LOAD) > until[0]) if until else rows
    return folded(kept.drop("_until").unionByName(later.drop(LOAD), allowMissingColumns=True), id_field, newest)


def compact(spark: SparkSession, log: str, snapshots: str, id_field: str, newest: str = "ingested_at") -> None:
    """Fold all loads of the log into a new snapshot. No run may be writing meanwhile; the next one continues."""
    until = read_log(spark, log).agg(F.max(LOAD)).first()[0]
    state = _current(spark, log, snapshots, id_field, newest).withColumn("_until", F.lit(until))
    tables.write_next_version(state, snapshots)
