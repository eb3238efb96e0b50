"""The scheduled steps: ingest, bronze export, silver, gold, and the single-machine variant of the last two."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane import schemas as S
from pitlane.operators import enrich, marts, marts_local, merge, quality, silver_local, sketches, staging
from pitlane.operators.silver import CLEANERS, DATASETS
from pitlane.session import stored_bytes
from pitlane.sources import bronze, linked, shared, tables

log = logging.getLogger(__name__)

GOLD = ["mart_market_pricing", "mart_catalog_coverage", "mart_supplier_performance", "mart_recall_impact"]


LOCAL_GOLD = ["mart_market_pricing_local", "mart_catalog_coverage_local", "mart_supplier_performance_local"]


def ingest_run(
    spark: SparkSession, landing: dict[str, DataFrame], root: str, run_log: str, started: datetime,
    makes: list[str] | None = None, model_years: list[int] | None = None, quarantine: str | None = None,
) -> None:
    """Merge landed documents into their tables and log the run.

    A table lies in ``BUCKETS`` buckets of keys. Documents are parsed and stored
    once, which tells the buckets they fall into; only these are read, merged
    and replaced, all others are linked to the new version. Outcomes, documents
    and unusable lines are counted by the stages that write. What a table cannot
    hold goes to a folder of ``quarantine`` for each run and feed.
    """
    now = F.lit(started.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    stats = []
    for name, documents in landing.items():
        moment = F.try_to_timestamp("ingested_at")
        if S.UNREAD in documents.columns:
            lost = F.create_map(F.lit("ingested_at"), F.when(moment.isNull(), F.col("ingested_at")))
            documents = documents.withColumn(
                S.UNREAD, F.map_concat(S.UNREAD, F.map_filter(lost, lambda _, text: text.isNotNull()))
            )
        batch = documents.withColumn("ingested_at", moment)
        if name == "vehicle_recalls":
            batch = merge.feed_filter(batch, makes, model_years)
        aside = None if quarantine is None else f"{quarantine}/run={started:%Y%m%d_%H%M%S}/collection={name}"
        stats.append((name, *merge_landed(batch, f"{root}/{name}", S.ID_FIELDS[name], now, quarantine=aside)))
    run = spark.createDataFrame(stats, "collection string, inserted long, updated long, errors long, total long")
    record = merge.run_record(run, merge.run_id(now), "ingestion", "success", now)
    tables.run_log_append(record.to(S.RUN_LOG), run_log)


#: Buckets of a keyed table from its first version on.
BUCKETS = 256
#: Stored bytes of landed documents and of the buckets they fall into that are merged at a time. Shuffled for the merge
#: and for its files they take about six times as much disk, which is free again for the next ones.
PASS_BYTES = 2 << 30


def merge_landed(
    batch: DataFrame, path: str, id_field: str, seen_at: Column, buckets: int = BUCKETS, quarantine: str | None = None
) -> tuple[int, int, int, int]:
    """Merge documents into the keyed table at ``path``; documents inserted, updated, in error, and received.

    What the table cannot hold replaces the folder ``quarantine``, so a run that is repeated leaves it once.
    """
    with shared.passing_path(batch.sparkSession, "landed") as aside:
        return _merge_landed(batch, path, id_field, seen_at, buckets, quarantine, aside)


def _merge_landed(
    batch: DataFrame, path: str, id_field: str, seen_at: Column, buckets: int, quarantine: str | None, aside: str
) -> tuple[int, int, int, int]:
    spark = batch.sparkSession
    base = linked.manifest(spark, path)
    buckets = int(base.properties["buckets"]) if base else buckets
    received = Observation()
    errors = merge.rejected() if S.CORRUPT in batch.columns else F.count(F.lit(None))
    bucket = F.when(merge.usable_key(batch, id_field), linked.bucket_of(id_field, buckets))
    landed = shared.store(
        batch.withColumn(linked.BUCKET, bucket).observe(
            received, F.count(F.lit(1)).alias("total"), errors.alias("errors"), F.collect_set(linked.BUCKET).alias("touched")
        ),
        "landed", aside,
    )
    told = received.get
    if quarantine is not None:
        merge.quarantined(landed.drop(linked.BUCKET), id_field).write.mode("overwrite").parquet(quarantine)
    landed, batch = landed.drop(S.FILE, S.UNREAD), batch.drop(S.FILE, S.UNREAD)
    touched = linked.bucket_folders(told["touched"])
    empty = merge.empty_target(batch, by_field=S.PRESENT in batch.columns)
    if base is None and not touched:
        nothing = empty.withColumn(linked.BUCKET, F.lit(0))
        linked.commit(nothing, path, [linked.BUCKET], properties={"buckets": str(buckets)})
    if not touched:
        return 0, 0, told["errors"], told["total"]

    def merged(numbers: list[int]) -> DataFrame:
        target = empty
        if base is not None:
            target = linked.read(spark, path, base, linked.bucket_folders(numbers)).drop(linked.BUCKET)
        those = landed.where(F.col(linked.BUCKET).between(numbers[0], numbers[-1])).drop(linked.BUCKET)
        return merge.merge_outcomes(target, those, id_field, seen_at)

    numbers = linked.folder_buckets(touched)
    if base is not None and linked.retyped(base.schema, merged(numbers).drop(merge.OUTCOME).schema):
        # Linked files could not be read with another type, so all are written again.
        touched = set(base.owners) | touched
        numbers = linked.folder_buckets(touched)
    stored = stored_bytes(spark, aside) + (linked.size_of(spark, path, base, touched) if base is not None else 0)
    each = -(-len(numbers) // max(1, -(-stored // PASS_BYTES)))
    passes = [numbers[at:at + each] for at in range(0, len(numbers), each)]
    outcomes = [Observation() for _ in passes]
    written = [
        merged(some).observe(seen, *merge.outcome_counts()).drop(merge.OUTCOME)
        .withColumn(linked.BUCKET, linked.bucket_of(id_field, buckets)).hint("rebalance", linked.BUCKET)
        for some, seen in zip(passes, outcomes)
    ]
    linked.commit(written, path, [linked.BUCKET], base, touched, {"buckets": str(buckets)})
    inserted, updated = (sum(seen.get[each] for seen in outcomes) for each in ("inserted", "updated"))
    return inserted, updated, told["errors"], told["total"]


def merged_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A keyed table as ``merge_landed`` left it."""
    found = linked.rows(spark, path)
    return None if found is None else found.drop(merge.AGES)


def export_run(
    spark: SparkSession, source: str, bronze_root: str, collections: list[str], run_date: str,
    format: str = "json", **options: str,
) -> dict[str, int]:
    """Export the given collections as one day of bronze JSON; returns documents per collection.

    ``format="tables"`` exports the newest versions of the tables that ``ingest_run`` merged under ``source``.
    """
    written = {}
    for name in collections:
        if format == "tables":
            documents = merged_table(spark, f"{source}/{name}")
            if documents is None:
                log.warning("no table of %s under %s, skipped", name, source)
                continue
            documents = documents.drop(merge.FIRST_SEEN).withColumn(
                "ingested_at", F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            )
        else:
            documents = bronze.bronze_read_documents(spark, source, name, format, **options)
        written[name] = bronze.bronze_export_json(documents, bronze_root, name, run_date)
    return written


def silver_run(
    spark: SparkSession, bronze_root: str, silver_root: str, datasets: list[str], run_date: str | None = None
) -> dict[str, int]:
    """Clean each dataset into silver; returns rows written, counted while writing.

    Unknown names are skipped with a warning, errors propagate. Silver is
    rebuilt from all exported days: ``run_date`` only names the run, as one day
    alone would remove the others.
    """
    if run_date is not None:
        log.info("silver run of %s over all exported days", run_date)
    written = {}
    for name in datasets:
        if name not in CLEANERS:
            log.warning("unknown dataset %s, skipped", name)
            continue
        raw = bronze.bronze_read_json(spark, bronze_root, name, columns=DATASETS[name].contract)
        # Stored between the shuffles of the deduplication and that by months, so that both never lie on disk together.
        with shared.passing_path(spark, f"cleaned_{name}") as path:
            cleaned = shared.store(CLEANERS[name](raw), name, path)
            written[name] = tables.silver_write_partitioned(cleaned, f"{silver_root}/{name}")
    return written


def silver_update(
    landed: DataFrame, silver_root: str, name: str, buckets: int = BUCKETS
) -> set[str]:
    """Bring silver up to date with newly landed raw documents; returns the months that were written.

    The survivor of each key is kept beside silver, in buckets of keys, also
    where its row is not in silver. Only the buckets of landed keys are read and
    replaced. A key whose survivor changed has its row taken out of the month of
    the old one and put into that of the new one; just these months are written,
    all others are linked. Silver comes first, and the survivors name the
    version it got: if a run ends in between, the next one starts from the
    version that the survivors name, or writes silver anew from the survivors if
    that is gone, as after a full rebuild in its place.
    """
    spark, dataset = landed.sparkSession, DATASETS[name]
    path, state = f"{silver_root}/{name}", f"{silver_root}/_survivors/{name}"
    known, base = linked.manifest(spark, state), linked.manifest(spark, path)
    named = int(known.properties["silver"]) if known else 0
    if named not in linked.versions(spark, path):
        base = None
    elif base.number != named:
        base = linked.revert(spark, path, named)
    buckets = int(known.properties["buckets"]) if known else buckets

    seen = Observation()
    candidates = dataset.candidates(landed).withColumn(linked.BUCKET, linked.bucket_of(dataset.key, buckets))
    new = shared.store(candidates.observe(seen, F.collect_set(linked.BUCKET).alias("touched")), f"landed_{name}")
    touched = linked.bucket_folders(seen.get["touched"])
    old = new.limit(0) if known is None else linked.read(spark, state, known, touched)
    competing = old.withColumn("_landed", F.lit(False)).unionByName(new.withColumn("_landed", F.lit(True)))
    # A landed row that equals the survivor changes nothing.
    after = shared.store(dataset.survivors(competing, F.col("_landed").asc()), f"survivors_{name}")
    changed = after.where("_landed").drop("_landed", linked.BUCKET)
    keys = shared.store(changed.select(F.col(dataset.key).alias("_changed")), f"changed_{name}")

    def those(df: DataFrame, how: str) -> DataFrame:
        return df.join(keys, df[dataset.key].eqNullSafe(keys["_changed"]), how)

    entering = shared.store(dataset.finished(changed), f"entering_{name}")
    leaving = dataset.finished(those(old.drop(linked.BUCKET), "left_semi"))
    months = entering.select(*S.SILVER_PARTITIONS).union(leaving.select(*S.SILVER_PARTITIONS)).distinct().collect()
    written = {linked.folder(m.asDict()) for m in months}
    if written or base is None:
        if base is not None:
            rows = those(linked.read(spark, path, base, written), "left_anti").unionByName(entering)
        else:
            rows = after.drop("_landed")
            if known is not None:
                rows = linked.read(spark, state, known, set(known.owners) - touched).unionByName(rows)
            rows = dataset.finished(rows.drop(linked.BUCKET))
        base = linked.commit(rows.hint("rebalance", *S.SILVER_PARTITIONS), path, S.SILVER_PARTITIONS, base, written)
    linked.commit(
        after.drop("_landed").hint("rebalance", linked.BUCKET), state, [linked.BUCKET], known, touched,
        {"buckets": str(buckets), "silver": str(base.number)},
    )
    return written


def sketches_update(
    landed: DataFrame, root: str, day: str, keys: list[str], distinct: list[str], values: list[str]
) -> set[str]:
    """Add the days of ``landed`` (``day`` a whole number, such as 20240305) to the sketches at ``root``.

    A day that is there already is replaced, so a load is whole days. Rows of other days are not read.
    """
    spark = landed.sparkSession
    daily = shared.store(sketches.daily_sketches(landed, day, keys, distinct, values), "daily_sketches")
    days = {linked.folder({day: r[0]}) for r in daily.select(day).distinct().collect()}
    base = linked.manifest(spark, root)
    linked.commit(daily.hint("rebalance", day), root, [day], base, days)
    return days


def sketched(
    spark: SparkSession, root: str, keys: list[str], probs: dict[str, float], first: int | None = None, last: int | None = None
) -> DataFrame:
    """Estimates over all days, or those from ``first`` to ``last``."""
    known = linked.manifest(spark, root)
    (day,) = known.partitions
    stored = linked.read(spark, root, known)
    if first is not None:
        stored = stored.where(F.col(day) >= first)
    if last is not None:
        stored = stored.where(F.col(day) <= last)
    return sketches.estimates(sketches.merged_sketches(stored, keys), keys, probs)


def silver_schema(spark: SparkSession, name: str) -> T.StructType:
    """What cleaning makes of the declared raw collection."""
    return CLEANERS[name](spark.createDataFrame([], S.BRONZE[name])).schema


def staging_views(spark: SparkSession, silver_root: str) -> dict[str, DataFrame]:
    """The staging models; a dataset that was not delivered, as recalls by default, is an empty one."""
    def stored(name: str) -> DataFrame:
        kept_up = linked.read(spark, f"{silver_root}/{name}")
        if kept_up is not None:
            return kept_up
        return tables.scan_parquet(spark, f"{silver_root}/{name}", silver_schema(spark, name))

    read = {name: stored(name) for name in CLEANERS}
    return {
        "stg_parts_catalog": staging.stg_parts(read["parts_catalog"]),
        "stg_market_listings": staging.stg_listings(read["market_listings"]),
        "stg_vehicle_recalls": staging.stg_recalls(read["vehicle_recalls"]),
    }


def gold_run(
    spark: SparkSession, silver_root: str, gold_root: str, run_ts: Column | None = None,
    coverage_input: DataFrame | None = None,
) -> None:
    """Build and validate the marts; raises if an invariant is broken.

    The enriched catalogue is stored once because two marts read it, and its
    price statistics so that their size is known when they are joined.
    """
    views = staging_views(spark, silver_root)
    catalog, listings, recalls = views.values()
    stats = shared.store(enrich.int_price_stats(catalog), "int_price_stats")
    tables.gold_materialize(
        enrich.int_parts_enriched(catalog, coverage_input, stats), gold_root, "int_parts_enriched", run_ts
    )
    enriched = tables.gold_read_mart(spark, gold_root, "int_parts_enriched")
    built = {
        "mart_market_pricing": marts.mart_market_pricing(enriched, listings),
        "mart_catalog_coverage": marts.mart_catalog_coverage(listings, recalls),
        "mart_supplier_performance": marts.mart_supplier_performance(enriched),
        "mart_recall_impact": marts.mart_recall_impact(recalls, listings),
    }
    for name, mart in built.items():
        tables.gold_materialize(mart, gold_root, name, run_ts)
    validate(spark, gold_root)


def flat_schema(spark: SparkSession, name: str) -> T.StructType:
    empty = spark.createDataFrame([], S.BRONZE[name])
    return bronze.bronze_nested_to_json(bronze.bronze_drop_internal(empty)).schema


def local_run(spark: SparkSession, bronze_root: str, silver_root: str, gold_root: str, run_ts: Column | None = None) -> None:
    """Flat bronze tables to silver to three marts, by the single-machine pipeline's rules."""
    parts, listings = (
        tables.scan_parquet(spark, f"{bronze_root}/{name}", flat_schema(spark, name))
        for name in ("parts_catalog", "market_listings")
    )
    tables.silver_write_flat(silver_local.silver_parts_local(parts), f"{silver_root}/parts_catalog")
    tables.silver_write_flat(silver_local.silver_listings_local(listings), f"{silver_root}/market_listings")
    parts = tables.scan_parquet(spark, f"{silver_root}/parts_catalog")
    listings = tables.scan_parquet(spark, f"{silver_root}/market_listings")
    built = {
        "mart_market_pricing_local": marts_local.mart_market_pricing_local(parts, listings),
        "mart_catalog_coverage_local": marts_local.mart_catalog_coverage_local(listings),
        "mart_supplier_performance_local": marts_local.mart_supplier_performance_local(parts),
    }
    for name, mart in built.items():
        tables.gold_materialize(mart, gold_root, name, run_ts)
    validate(spark, gold_root, "_local")


def validate(spark: SparkSession, gold_root: str, suffix: str = "") -> None:
    """The report has one row per check, so reading it here is bounded."""
    report = quality.dq_gold_validate(
        tables.gold_read_mart(spark, gold_root, f"mart_market_pricing{suffix}", ordered=False),
        tables.gold_read_mart(spark, gold_root, f"mart_catalog_coverage{suffix}", ordered=False),
    )
    broken = report.where("failures > 0").collect()
    if broken:
        raise ValueError("gold validation failed: " + ", ".join(f"{r['check']}: {r['failures']}" for r in broken))
