"""One query per operator, over whole base tables.

Where an operator returns doubles that no step of it rounds, the query rounds
them, since sums of doubles depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane import schemas as S
from pitlane.functions import keys, rnd
from pitlane.operators import derive, enrich, lookup, marts, marts_local, merge, quality, serving, silver, silver_local
from pitlane.plans import pipeline
from pitlane.plans.lake import Lake
from pitlane.sources import bronze, linked, tables
from pitlane.streaming import feed

RUN_DATE = "2024-03-05"
EARLIER_RUN_DATE = "2024-03-04"
RUN_TS = "2024-03-05T04:00:00"
FIRST_LOAD, SECOND_LOAD = "2024-03-04 01:00:00", "2024-03-05 01:00:00"
# Base-table dates that split the collections into an earlier and a later load;
# the event loads overlap, so that the second one brings replays and late documents.
SPLIT = "1998-07-01"
EVENTS_TO, EVENTS_FROM = "2024-01-20", "2024-01-10"

QUERIES: dict[str, Callable[[Lake], DataFrame]] = {}


def _query(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: rnd(c, digits) for c in columns})


def _before(column: str, moment: str):
    """Rows without a date count as later, so that no load loses them."""
    return F.coalesce(F.col(column) < moment, F.lit(False))


def _ts(text: str):
    return F.lit(text).cast("timestamp")


# --- bronze -----------------------------------------------------------------


@_query
def bronze_read_documents(lake: Lake) -> DataFrame:
    root = lake.path("documents")
    bronze.write_lines(lake.raw("vehicle_recalls"), f"{root}/vehicle_recalls")
    return bronze.bronze_read_documents(lake.spark, root, "vehicle_recalls")


@_query
def bronze_read_spellings(lake: Lake) -> DataFrame:
    """Whole numbers written as ``12.0`` or as text, and prices as text, arrive as they were."""
    root, listings = lake.path("documents"), lake.raw("market_listings")
    spelt = listings.withColumns({
        "vehicle_year": F.col("vehicle_year").cast("double"),
        "days_to_sell": F.concat(F.col("days_to_sell").cast("string"), F.lit(".0")),
        "asking_price_eur": F.col("asking_price_eur").cast("string"),
    })
    bronze.write_lines(spelt, f"{root}/market_listings")
    return bronze.bronze_read_documents(lake.spark, root, "market_listings")


@_query
def bronze_drop_internal(lake: Lake) -> DataFrame:
    return bronze.bronze_drop_internal(lake.raw("vehicle_recalls"))


@_query
def bronze_date_stamp(lake: Lake) -> DataFrame:
    return bronze.bronze_date_stamp(lake.raw("market_listings"), RUN_DATE)


@_query
def bronze_export_json(lake: Lake) -> DataFrame:
    root = lake.path("bronze")
    n = bronze.bronze_export_json(lake.raw("parts_catalog"), root, "parts_catalog", RUN_DATE)
    written = bronze.bronze_read_json(lake.spark, root, "parts_catalog")
    return bronze.bronze_nested_to_json(written).withColumn("documents_written", F.lit(n).cast("long"))


@_query
def bronze_nested_to_json(lake: Lake) -> DataFrame:
    return bronze.bronze_nested_to_json(lake.raw("parts_catalog"))


@_query
def bronze_write_parquet(lake: Lake) -> DataFrame:
    root = lake.path("bronze-flat")
    bronze.bronze_write_parquet(lake.raw("vehicle_recalls"), root, "vehicle_recalls")
    return lake.spark.read.parquet(f"{root}/vehicle_recalls")


@_query
def bronze_read_json(lake: Lake) -> DataFrame:
    """Two exported days, read together."""
    root, listings = lake.path("bronze"), lake.raw("market_listings")
    early = _before("ingested_at", SPLIT)
    bronze.bronze_export_json(listings.where(early), root, "market_listings", EARLIER_RUN_DATE)
    bronze.bronze_export_json(listings.where(~early), root, "market_listings", RUN_DATE)
    return bronze.bronze_read_json(lake.spark, root, "market_listings")


@_query
def scan_parquet(lake: Lake) -> DataFrame:
    path = lake.path("silver-parts")
    tables.silver_write_partitioned(lake.silver("parts_catalog"), path)
    return tables.scan_parquet(lake.spark, path)


@_query
def silver_write_partitioned(lake: Lake) -> DataFrame:
    path = lake.path("silver-listings")
    tables.silver_write_partitioned(lake.silver("market_listings"), path)
    return lake.spark.read.parquet(path)


@_query
def silver_write_flat(lake: Lake) -> DataFrame:
    path = lake.path("silver-recalls")
    tables.silver_write_flat(lake.silver("vehicle_recalls"), path)
    return lake.spark.read.parquet(path)


@_query
def silver_run(lake: Lake) -> DataFrame:
    """Bronze JSON to silver for all datasets; rows per dataset as stored and as counted while writing."""
    root, out = lake.path("bronze"), lake.path("silver")
    for name in S.BRONZE:
        bronze.bronze_export_json(lake.raw(name), root, name, RUN_DATE)
    written = pipeline.silver_run(lake.spark, root, out, [*S.BRONZE, "unknown"])
    counts = [
        lake.spark.read.parquet(f"{out}/{name}").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("dataset"), "n_rows", F.lit(n).cast("long").alias("n_written"))
        for name, n in written.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _silver(lake: Lake, name: str) -> DataFrame:
    """Rows of a dataset as the silver step stores them from exported documents."""

    def run() -> str:
        root, out = lake.path("bronze"), lake.path("silver")
        for each in S.BRONZE:
            bronze.bronze_export_json(lake.raw(each), root, each, RUN_DATE)
        pipeline.silver_run(lake.spark, root, out, [*S.BRONZE])
        return out

    return lake.spark.read.parquet(f"{lake.once('silver_run', run)}/{name}")


@_query
def silver_run_parts(lake: Lake) -> DataFrame:
    return _silver(lake, "parts_catalog")


@_query
def silver_run_listings(lake: Lake) -> DataFrame:
    return _silver(lake, "market_listings")


@_query
def silver_run_recalls(lake: Lake) -> DataFrame:
    return _silver(lake, "vehicle_recalls")


def _updated(lake: Lake, name: str) -> DataFrame:
    """Silver after three loads, the latest documents first, then the earliest, then all that are left."""
    root, raw = lake.path("silver-kept-up"), lake.raw(name)
    late, early = ~_before("ingested_at", SPLIT), _before("ingested_at", "1994-01-01")
    for part in (late, early, ~late & ~early):
        pipeline.silver_update(raw.where(part), root, name)
    return linked.read(lake.spark, f"{root}/{name}")


@_query
def silver_update_parts(lake: Lake) -> DataFrame:
    return _updated(lake, "parts_catalog")


@_query
def silver_update_listings(lake: Lake) -> DataFrame:
    return _updated(lake, "market_listings")


@_query
def silver_update_recalls(lake: Lake) -> DataFrame:
    return _updated(lake, "vehicle_recalls")


@_query
def gold_materialize(lake: Lake) -> DataFrame:
    root = lake.path("gold")
    tables.gold_materialize(lake.pricing(), root, "mart_market_pricing", _ts(RUN_TS))
    return tables.gold_read_mart(lake.spark, root, "mart_market_pricing", ordered=False).withColumn(
        "updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss")
    )


@_query
def gold_export_parquet(lake: Lake) -> DataFrame:
    return _exported(lake, "mart_supplier_performance_local")


@_query
def gold_export_pricing(lake: Lake) -> DataFrame:
    return _exported(lake, "mart_market_pricing_local")


@_query
def gold_export_coverage(lake: Lake) -> DataFrame:
    return _exported(lake, "mart_catalog_coverage_local")


def _exported(lake: Lake, name: str) -> DataFrame:
    """One mart of an export of all three."""
    root, out = lake.path("gold"), lake.path("gold-export")
    built = {
        "mart_market_pricing_local": lake.pricing_local(),
        "mart_catalog_coverage_local": lake.coverage_local(),
        "mart_supplier_performance_local": lake.suppliers_local(),
    }
    for mart, df in built.items():
        tables.gold_materialize(df, root, mart, _ts(RUN_TS))
    tables.gold_export_parquet(lake.spark, list(built), root, out)
    return tables.gold_read_mart(lake.spark, out, name, ordered=False).drop("updated_at")


@_query
def gold_read_mart(lake: Lake) -> DataFrame:
    root = lake.path("gold")
    tables.gold_materialize(lake.coverage_local(), root, "mart_catalog_coverage_local", _ts(RUN_TS))
    return tables.gold_read_mart(lake.spark, root, "mart_catalog_coverage_local").drop("updated_at")


@_query
def local_run(lake: Lake) -> DataFrame:
    """The single-machine pipeline from flat bronze tables to its pricing mart."""
    root, out, gold = lake.path("bronze-flat"), lake.path("silver-flat"), lake.path("gold-local")
    for name in ("parts_catalog", "market_listings"):
        bronze.bronze_write_parquet(lake.raw(name), root, name)
    pipeline.local_run(lake.spark, root, out, gold, _ts(RUN_TS))
    return tables.gold_read_mart(lake.spark, gold, "mart_market_pricing_local").drop("updated_at")


def _gold(lake: Lake) -> str:
    silver_root, gold = lake.path("silver"), lake.path("gold")
    for name in S.BRONZE:
        lake.write_silver(name, f"{silver_root}/{name}")
    pipeline.gold_run(lake.spark, silver_root, gold, _ts(RUN_TS))
    return gold


def _mart(lake: Lake, name: str) -> DataFrame:
    """Rows of a mart as the gold step stores them."""
    gold = lake.once("gold_run", lambda: _gold(lake))
    return tables.gold_read_mart(lake.spark, gold, name, ordered=False).drop("updated_at")


@_query
def gold_run_suppliers(lake: Lake) -> DataFrame:
    return _mart(lake, "mart_supplier_performance")


@_query
def gold_run_pricing(lake: Lake) -> DataFrame:
    return _mart(lake, "mart_market_pricing")


@_query
def gold_run_coverage(lake: Lake) -> DataFrame:
    return _mart(lake, "mart_catalog_coverage")


@_query
def gold_run_impact(lake: Lake) -> DataFrame:
    return _mart(lake, "mart_recall_impact")


@_query
def gold_run(lake: Lake) -> DataFrame:
    """All marts from stored silver; rows per mart."""
    gold = _gold(lake)
    return reduce(DataFrame.unionByName, [
        tables.gold_read_mart(lake.spark, gold, name, ordered=False).agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("mart"), "n_rows")
        for name in pipeline.GOLD
    ])


@_query
def catalog_register(lake: Lake) -> DataFrame:
    path = lake.path("silver-external")
    parts = lake.silver("parts_catalog").withColumn("ingested_date", F.to_date("ingested_at")).select(
        "part_id", "part_number", "brand", "category", "price_eur", "source", "ingested_date", *S.SILVER_PARTITIONS
    )
    tables.silver_write_partitioned(parts, path)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    table = tables.catalog_register(lake.spark, name, parts.schema, S.SILVER_PARTITIONS, path)
    return table.withColumn("ingested_date", F.col("ingested_date").cast("string"))


# --- ingest -----------------------------------------------------------------


def _event_loads(lake: Lake) -> tuple[DataFrame, DataFrame]:
    events = lake.events()
    first = events.where(_before("ingested_at", EVENTS_TO))
    second = events.where(~_before("ingested_at", EVENTS_FROM))
    return merge.ingest_upsert(merge.empty_target(first), first, "user_id", _ts(FIRST_LOAD)), second


def _shown(state: DataFrame) -> DataFrame:
    return state.withColumns({
        c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("ingested_at", merge.FIRST_SEEN)
    })


@_query
def ingest_upsert(lake: Lake) -> DataFrame:
    """The second load lacks ``props``, so stored values stay."""
    target, batch = _event_loads(lake)
    return _shown(merge.ingest_upsert(target, batch.drop("props"), "user_id", _ts(SECOND_LOAD)))


@_query
def ingest_stats(lake: Lake) -> DataFrame:
    target, batch = _event_loads(lake)
    return merge.ingest_stats(target, batch, "user_id", "events")


@_query
def ingest_stream_upsert(lake: Lake) -> DataFrame:
    """Two loads land one after the other; each is streamed into the log from where the last one stopped."""
    landing, log, checkpoint = lake.path("landing"), lake.path("log"), lake.path("stream-checkpoint")
    events = lake.events()
    later = ~_before("ingested_at", EVENTS_FROM)
    for load in (events.where(later), events.where(~later)):
        load.write.mode("append").option("timestampFormat", feed.TIMESTAMPS).json(landing)
        source = feed.read_feed(lake.spark, landing, events.schema)
        feed.ingest_stream_upsert(source, log, checkpoint, "user_id", F.col("ingested_at")).awaitTermination()
    return _shown(feed.current_state(lake.spark.read.parquet(log), "user_id"))


def _partial_documents(lake: Lake) -> DataFrame:
    """Events of which some lack ``props`` and some ``value``; nulls are not written."""
    return lake.events().withColumns({
        "props": F.when(F.col("event_id") % 3 != 0, F.col("props")),
        "value": F.when(F.col("event_id") % 2 != 0, F.col("value")),
    })


@_query
def ingest_fields_batch(lake: Lake) -> DataFrame:
    """Two loads of documents that lack fields: a field keeps its value until a document sends it again."""
    events = _partial_documents(lake)
    early = _before("ingested_at", EVENTS_TO)
    state = None
    for part, moment in ((early, FIRST_LOAD), (~early, SECOND_LOAD)):
        landing = lake.path("landing")
        events.where(part).write.option("timestampFormat", feed.TIMESTAMPS).json(landing)
        batch = bronze.bronze_read_lines(lake.spark, landing, events.schema)
        state = merge.ingest_upsert(
            merge.empty_target(batch) if state is None else state, batch, "user_id", _ts(moment)
        )
    return _shown(state)


@_query
def ingest_fields_late(lake: Lake) -> DataFrame:
    """The later documents first, through the stored table: what the earlier ones sent fills fields never sent since."""
    events, table = _partial_documents(lake), lake.path("fields-late")
    early = _before("ingested_at", EVENTS_TO)
    for part, moment in ((~early, FIRST_LOAD), (early, SECOND_LOAD)):
        landing = lake.path("landing")
        events.where(part).write.option("timestampFormat", feed.TIMESTAMPS).json(landing)
        batch = bronze.bronze_read_lines(lake.spark, landing, events.schema)
        pipeline.merge_landed(batch, table, "user_id", _ts(moment))
    return _shown(pipeline.merged_table(lake.spark, table))


@_query
def ingest_quarantine(lake: Lake) -> DataFrame:
    """Events of which some lines are cut off, some lack the key and some have a value that is no number: what was rejected."""
    landing, table, aside = lake.path("spoilt"), lake.path("spoilt-table"), lake.path("quarantine")
    events = lake.events()
    spoilt = events.withColumns({
        "user_id": F.when(F.col("event_id") % 89 != 0, F.col("user_id")),
        "value": F.when(F.col("event_id") % 83 == 0, F.concat(F.lit("about "), F.col("event_id").cast("string")))
        .otherwise(F.col("value").cast("string")),
    })
    line = F.to_json(F.struct(*events.columns), {"timestampFormat": feed.TIMESTAMPS})
    cut = F.when(F.col("event_id") % 97 == 0, F.substring(line, F.lit(1), F.length(line) - 2)).otherwise(line)
    spoilt.select(cut.alias("value")).write.text(landing)
    batch = bronze.bronze_read_lines(lake.spark, landing, events.schema, told=True)
    inserted, updated, errors, total = pipeline.merge_landed(batch, table, "user_id", _ts(FIRST_LOAD), quarantine=aside)
    rejected = lake.spark.read.parquet(aside)
    return rejected.groupBy("reason", "field").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("content").alias("contents"), F.count("file").alias("with_file"),
    ).withColumns({"inserted": F.lit(inserted).cast("long"), "errors": F.lit(errors).cast("long"), "total": F.lit(total).cast("long")})


@_query
def ingest_fields_stream(lake: Lake) -> DataFrame:
    """The same documents streamed in two runs, compacted after each, the later ones first."""
    names = ("landing", "log", "checkpoint", "snapshots")
    landing, log, checkpoint, snapshots = (lake.path(f"fields-{n}") for n in names)
    events = _partial_documents(lake)
    early = _before("ingested_at", EVENTS_TO)
    for load, part in (("1", ~early), ("2", early)):
        events.where(part).write.mode("append").option("timestampFormat", feed.TIMESTAMPS).json(landing)
        source = feed.read_feed(lake.spark, landing, events.schema, by_field=True)
        feed.ingest_stream_upsert(source, log, checkpoint, "user_id", F.col("ingested_at"), load).awaitTermination()
        feed.compact(lake.spark, log, snapshots, "user_id")
    return _shown(feed.current(lake.spark, log, snapshots, "user_id"))


def _feed(lake: Lake, collection: str, **filters) -> DataFrame:
    documents = lake.documents(collection)
    early = _before("ingested_at", SPLIT)
    first = documents.where(early)
    target = merge.ingest_feed(merge.empty_target(first), first, collection, _ts(FIRST_LOAD), **filters)
    merged = merge.ingest_feed(target, documents.where(~early), collection, _ts(SECOND_LOAD), **filters)
    return bronze.bronze_nested_to_json(_shown(merged))


@_query
def ingest_feed_parts(lake: Lake) -> DataFrame:
    return _feed(lake, "parts_catalog")


@_query
def ingest_feed_listings(lake: Lake) -> DataFrame:
    return _feed(lake, "market_listings")


FEED_MAKES = ["nation_1", "nation_4", "nation_7", "nation_12", "nation_20"]
FEED_YEARS = [1996, 1997, 1998, 1999, 2000]


@_query
def ingest_feed_recalls(lake: Lake) -> DataFrame:
    return _feed(lake, "vehicle_recalls", makes=FEED_MAKES, model_years=FEED_YEARS)


@_query
def run_log_append(lake: Lake) -> DataFrame:
    """Two runs of the event load: the second one repeats it and changes nothing."""
    log = lake.path("pipeline_runs")
    target, batch = _event_loads(lake)
    merged = merge.ingest_upsert(target, batch, "user_id", _ts(SECOND_LOAD))
    for started, table in ((FIRST_LOAD, target), (SECOND_LOAD, merged)):
        stats = merge.ingest_stats(table, batch, "user_id", "events")
        record = merge.run_record(stats, merge.run_id(_ts(started)), "ingestion", "success", _ts(started))
        tables.run_log_append(record.to(S.RUN_LOG), log)
    runs = lake.spark.read.schema(S.RUN_LOG).parquet(log)
    return runs.select(
        "run_id", "dag_id", "status", "total_docs",
        F.col("results")["events"]["inserted"].alias("inserted"),
        F.col("results")["events"]["updated"].alias("updated"),
        F.date_format("recorded_at", "yyyy-MM-dd HH:mm:ss").alias("recorded_at"),
    )


@_query
def ingest_run_recalls(lake: Lake) -> DataFrame:
    """Rows of a merged table after two scheduled loads."""
    root, _ = _two_loads(lake, ["vehicle_recalls"])
    return _shown(pipeline.merged_table(lake.spark, f"{root}/vehicle_recalls"))


def _two_loads(lake: Lake, collections: list[str]) -> tuple[str, str]:
    root, log = lake.path("tables"), lake.path("pipeline_runs")
    early = _before("ingested_at", SPLIT)
    for started, where in ((FIRST_LOAD, early), (SECOND_LOAD, ~early)):
        landed = {name: lake.raw(name).where(where) for name in collections}
        pipeline.ingest_run(lake.spark, landed, root, log, datetime.fromisoformat(started))
    return root, log


@_query
def ingest_run(lake: Lake) -> DataFrame:
    """Two scheduled loads of all three feeds; the run log with one row per run and feed."""
    _, log = _two_loads(lake, [*S.BRONZE])
    runs = lake.spark.read.schema(S.RUN_LOG).parquet(log)
    return runs.select("run_id", "status", "total_docs", F.explode("results").alias("collection", "stats")).select(
        "run_id", "status", "total_docs", "collection", "stats.*"
    )


@_query
def export_summary(lake: Lake) -> DataFrame:
    return merge.export_summary({**{name: lake.raw(name) for name in S.BRONZE}, "complaints": None})


# --- record derivation ------------------------------------------------------


def _numbered_parts(lake: Lake) -> DataFrame:
    """Brand words stand in for maker names, part types for categories."""
    return lake.table("part").select(
        "p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("category"),
        keys.part_number(F.col("p_name"), F.col("p_type"), F.col("p_partkey")).alias("part_number"),
    )


@_query
def key_part_number(lake: Lake) -> DataFrame:
    return _numbered_parts(lake)


@_query
def key_part_number_variant(lake: Lake) -> DataFrame:
    return _numbered_parts(lake).withColumn("part_number_source", keys.part_number_variant(F.col("part_number")))


@_query
def key_fingerprint(lake: Lake) -> DataFrame:
    return _numbered_parts(lake).withColumn("_fingerprint", keys.fingerprint(F.col("part_number"), F.col("brand")))


def _fits(lake: Lake) -> DataFrame:
    """Which vehicle a part was ordered for: make from the customer's nation, model from the part type."""
    return (
        lake.table("lineitem").join(lake.table("orders"), F.expr("l_orderkey = o_orderkey"))
        .join(lake.table("customer"), F.expr("o_custkey = c_custkey"))
        .join(lake.table("nation"), F.expr("c_nationkey = n_nationkey"))
        .select(
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("part_number"),
            F.col("n_name").alias("make"), F.col("c_mktsegment").alias("model"),
            F.year("o_orderdate").alias("year"),
        )
    )


@_query
def parts_compatibility_build(lake: Lake) -> DataFrame:
    return bronze.bronze_nested_to_json(derive.parts_compatibility_build(_fits(lake)))


@_query
def parts_description(lake: Lake) -> DataFrame:
    offers = lake.table("lineitem").join(lake.table("part"), F.expr("l_partkey = p_partkey")).join(
        lake.table("supplier"), F.expr("l_suppkey = s_suppkey")
    )
    return offers.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        keys.description(F.col("p_brand"), F.col("p_type"), F.col("s_name")).alias("description"),
    )


def _campaigns(lake: Lake) -> DataFrame:
    """Raw campaign answers. Fields are absent where their source is null."""
    recalls = lake.raw("vehicle_recalls")
    return recalls.select(
        "make", "model", "model_year",
        F.to_json(F.struct(
            F.col("recall_id").alias("NHTSACampaignNumber"),
            F.when(F.col("model_year") > 1980, F.col("manufacturer")).alias("Manufacturer"),
            F.col("component").alias("Component"),
            F.when(F.col("component").startswith("S"), F.col("consequence")).alias("Conséquence"),
            F.when(F.col("component") != "Carburant", F.lit("Fire")).alias("Consequence"),
            F.col("remedy").alias("Remedy"),
            F.col("report_received_date").alias("ReportReceivedDate"),
            F.col("potentially_affected").alias("PotentialNumberOfUnitsAffected"),
        )).alias("_raw"),
    )


@_query
def recall_normalize(lake: Lake) -> DataFrame:
    return derive.recall_normalize(_campaigns(lake), RUN_TS).drop("_raw")


def _complaints(lake: Lake) -> DataFrame:
    return lake.table("events").select(
        F.concat(F.lit("MAKE "), (F.col("user_id") % 10).cast("string")).alias("make"),
        F.concat(F.lit("Model "), (F.col("user_id") % 7).cast("string")).alias("model"),
        F.year("ts").alias("model_year"),
        F.to_json(F.struct(
            F.col("event_id").alias("odiNumber"),
            F.when(F.col("value") > 5, F.col("event_type")).alias("components"),
            F.col("props").alias("complaint"),
            F.when(F.col("value") > 10, F.col("value") > 20).alias("crash"),
            F.when(F.col("value") > 15, F.floor("value")).alias("numberOfInjuries"),
            F.date_format("ts", "dd/MM/yyyy").alias("dateOfIncident"),
        )).alias("_raw"),
    )


@_query
def complaint_normalize(lake: Lake) -> DataFrame:
    return derive.complaint_normalize(_complaints(lake), RUN_TS).drop("_raw")


# --- silver -----------------------------------------------------------------


@_query
def silver_parts(lake: Lake) -> DataFrame:
    return silver.silver_parts(lake.raw("parts_catalog"))


@_query
def silver_recalls(lake: Lake) -> DataFrame:
    return silver.silver_recalls(lake.placed("vehicle_recalls"))


@_query
def silver_listings(lake: Lake) -> DataFrame:
    return silver.silver_listings(lake.placed("market_listings"))


def _iso(df: DataFrame) -> DataFrame:
    return df.withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"))


@_query
def silver_parts_local(lake: Lake) -> DataFrame:
    return _iso(silver_local.silver_parts_local(lake.raw_flat("parts_catalog")))


@_query
def silver_listings_local(lake: Lake) -> DataFrame:
    return _iso(silver_local.silver_listings_local(lake.raw_flat("market_listings")))


@_query
def silver_listings_scheduled(lake: Lake) -> DataFrame:
    return _iso(silver_local.silver_listings_local(lake.raw_flat("market_listings"), strip_category=False))


# --- staging, enrichment, marts ---------------------------------------------


@_query
def stg_parts(lake: Lake) -> DataFrame:
    return lake.stg_parts()


@_query
def stg_listings(lake: Lake) -> DataFrame:
    return lake.stg_listings()


@_query
def stg_recalls(lake: Lake) -> DataFrame:
    return lake.stg_recalls()


@_query
def int_price_stats(lake: Lake) -> DataFrame:
    stats = enrich.int_price_stats(lake.stg_parts())
    return _rounded(stats, 6, "q1", "median_price", "q3", "avg_price", "stddev_price")


@_query
def int_source_coverage(lake: Lake) -> DataFrame:
    return _rounded(enrich.int_source_coverage(lake.stg_parts()), 6, "avg_price_cross_source")


@_query
def int_source_coverage_multisource(lake: Lake) -> DataFrame:
    """Over all quotes of a part."""
    return _rounded(enrich.int_source_coverage(lake.all_quotes()), 6, "avg_price_cross_source")


def _enriched(df: DataFrame) -> DataFrame:
    return _rounded(
        df, 6, "category_median_price", "category_avg_price", "category_q1", "category_q3"
    )


@_query
def int_parts_enriched(lake: Lake) -> DataFrame:
    return _enriched(enrich.int_parts_enriched(lake.stg_parts(), price_stats=lake.price_stats()))


@_query
def int_parts_enriched_multisource(lake: Lake) -> DataFrame:
    return _enriched(enrich.int_parts_enriched(lake.stg_parts(), lake.all_quotes(), lake.price_stats()))


@_query
def int_price_outlier(lake: Lake) -> DataFrame:
    """All quotes against the quartiles of the catalogue, with a threshold that some of them exceed."""
    stats = lake.price_stats().select("category", "brand_type", "q1", "q3")
    quotes = lake.all_quotes().select("part_id", "category", "brand_type", "price_eur")
    flag = enrich.int_price_outlier(F.col("price_eur"), F.col("q1"), F.col("q3"), 0.5)
    return quotes.join(stats, ["category", "brand_type"], "left").select(
        "part_id", "price_eur", flag.alias("is_price_outlier")
    )


@_query
def int_reliability_score(lake: Lake) -> DataFrame:
    enriched = lake.enriched_multisource()
    score = enrich.int_reliability_score(F.col("nb_sources"), F.col("quality_score"), F.col("price_spread_ratio"))
    return enriched.select("part_id", rnd(score, 4).alias("reliability_score"))


@_query
def pricing_catalog_side(lake: Lake) -> DataFrame:
    return marts.pricing_catalog_side(lake.enriched())


@_query
def pricing_market_side(lake: Lake) -> DataFrame:
    return marts.pricing_market_side(lake.stg_listings())


@_query
def supplier_sketches(lake: Lake) -> DataFrame:
    """Quotes by month into sketches, in two loads; whether the merged estimates are within four deviations of the truth."""
    root, keys = lake.path("supplier-sketches"), marts.SUPPLIER_KEYS
    quotes = lake.all_quotes().where(F.col("supplier").isNotNull()).withColumn(
        "month", F.coalesce(F.col("ingested_year") * 100 + F.col("ingested_month"), F.lit(0))
    )
    for part in (F.col("month") < 199501, F.col("month") >= 199501):
        pipeline.sketches_update(quotes.where(part), root, "month", keys, ["part_number"], ["price_eur"])
    found = pipeline.sketched(lake.spark, root, keys, {"median": 0.5})
    exact = quotes.groupBy(*keys).agg(F.countDistinct("part_number").alias("exact"))
    below = lookup.join_groups(quotes.where(F.col("price_eur").isNotNull()), found, keys).groupBy(*keys).agg(
        (F.count_if(F.col("price_eur").cast("double") <= F.col("median_price_eur")) >= 0.43 * F.count(F.lit(1))).alias("reached"),
        (F.count_if(F.col("price_eur").cast("double") < F.col("median_price_eur")) <= 0.57 * F.count(F.lit(1))).alias("not_past"),
    )
    joined = lookup.join_groups(lookup.join_groups(found, exact, keys), below, keys)
    return joined.select(
        *keys, "n_rows", (F.abs(F.col("nb_part_number") - F.col("exact")) <= 0.065 * F.col("exact") + 1).alias("count_near"),
        (F.col("reached") & F.col("not_past")).alias("median_near"),
    )


@_query
def mart_market_pricing(lake: Lake) -> DataFrame:
    return marts.mart_market_pricing(lake.enriched(), lake.stg_listings())


@_query
def mart_market_pricing_multisource(lake: Lake) -> DataFrame:
    return marts.mart_market_pricing(lake.enriched_multisource(), lake.stg_listings())


@_query
def mart_market_pricing_local(lake: Lake) -> DataFrame:
    return marts_local.mart_market_pricing_local(lake.silver_parts_local(), lake.silver_listings_local())


@_query
def coverage_by_vehicle(lake: Lake) -> DataFrame:
    return marts.coverage_by_vehicle(lake.stg_listings())


@_query
def coverage_totals(lake: Lake) -> DataFrame:
    return marts.coverage_totals(marts.coverage_by_vehicle(lake.stg_listings()))


@_query
def recalls_by_vehicle(lake: Lake) -> DataFrame:
    return marts.recalls_by_vehicle(lake.stg_recalls())


@_query
def mart_catalog_coverage(lake: Lake) -> DataFrame:
    return marts.mart_catalog_coverage(lake.stg_listings(), lake.stg_recalls())


@_query
def mart_catalog_coverage_normkey(lake: Lake) -> DataFrame:
    return marts.mart_catalog_coverage(lake.stg_listings(), lake.stg_recalls(), normalize_keys=True)


@_query
def mart_catalog_coverage_local(lake: Lake) -> DataFrame:
    return marts_local.mart_catalog_coverage_local(lake.silver_listings_local())


@_query
def supplier_catalog_perf(lake: Lake) -> DataFrame:
    return marts.supplier_catalog_perf(lake.enriched())


@_query
def seller_market_perf(lake: Lake) -> DataFrame:
    return marts.seller_market_perf(lake.stg_listings())


@_query
def mart_supplier_performance(lake: Lake) -> DataFrame:
    return marts.mart_supplier_performance(lake.enriched())


@_query
def mart_supplier_performance_multisource(lake: Lake) -> DataFrame:
    return marts.mart_supplier_performance(lake.enriched_multisource())


@_query
def mart_supplier_performance_local(lake: Lake) -> DataFrame:
    return marts_local.mart_supplier_performance_local(lake.silver_parts_local())


@_query
def recall_summary(lake: Lake) -> DataFrame:
    return marts.recall_summary(lake.stg_recalls())


@_query
def recall_parts_availability(lake: Lake) -> DataFrame:
    return marts.recall_parts_availability(lake.stg_listings())


@_query
def mart_recall_impact(lake: Lake) -> DataFrame:
    return marts.mart_recall_impact(lake.stg_recalls(), lake.stg_listings())


@_query
def mart_recall_impact_normkey(lake: Lake) -> DataFrame:
    return marts.mart_recall_impact(lake.stg_recalls(), lake.stg_listings(), normalize_keys=True)


# --- data quality -----------------------------------------------------------


@_query
def dq_not_null(lake: Lake) -> DataFrame:
    models = lake.staging()
    return quality.dq_not_null({m: (models[m], quality.NOT_NULL[m]) for m in models})


@_query
def dq_unique(lake: Lake) -> DataFrame:
    """Over the raw listings, whose ids collide."""
    return quality.dq_unique(lake.raw("market_listings"), "listing_id")


@_query
def dq_accepted_values(lake: Lake) -> DataFrame:
    """Over the raw catalogue, whose values are not normalised yet."""
    return quality.dq_accepted_values(
        lake.raw("parts_catalog"), "availability", quality.ACCEPTED["stg_parts_catalog"]["availability"]
    )


@_query
def dq_report(lake: Lake) -> DataFrame:
    return quality.dq_report(lake.staging())


@_query
def dq_no_negative_prices(lake: Lake) -> DataFrame:
    return quality.dq_no_negative_prices(lake.enriched())


@_query
def dq_reliability_bounded(lake: Lake) -> DataFrame:
    return quality.dq_reliability_bounded(lake.enriched())


@_query
def dq_gold_validate(lake: Lake) -> DataFrame:
    return quality.dq_gold_validate(lake.pricing_local(), lake.coverage_local())


# --- serving ----------------------------------------------------------------


@_query
def kpi_overview(lake: Lake) -> DataFrame:
    return _rounded(serving.kpi_overview(lake.pricing_local(), lake.coverage_local()), 6, "avg_quality")


@_query
def top_categories(lake: Lake) -> DataFrame:
    return serving.top_categories(lake.pricing_local())


@_query
def catalog_vs_market(lake: Lake) -> DataFrame:
    return serving.catalog_vs_market(lake.pricing_local())


@_query
def pricing_category_list(lake: Lake) -> DataFrame:
    return serving.pricing_category_list(lake.pricing_local())


@_query
def pricing_by_category(lake: Lake) -> DataFrame:
    return serving.pricing_by_category(lake.pricing_local(), "Freinage")


@_query
def pricing_by_category_all(lake: Lake) -> DataFrame:
    return serving.pricing_by_category(lake.pricing_local())


@_query
def pricing_long(lake: Lake) -> DataFrame:
    return serving.pricing_long(lake.pricing_local())


@_query
def liquidity_counts(lake: Lake) -> DataFrame:
    return serving.liquidity_counts(lake.pricing_local())


@_query
def coverage_top(lake: Lake) -> DataFrame:
    return serving.coverage_top(lake.coverage_local(), 10)


@_query
def coverage_top20(lake: Lake) -> DataFrame:
    return serving.coverage_top(lake.coverage_local(), 20)


@_query
def coverage_vs_volume(lake: Lake) -> DataFrame:
    return serving.coverage_vs_volume(lake.coverage_local())


@_query
def supplier_kpis(lake: Lake) -> DataFrame:
    return _rounded(serving.supplier_kpis(lake.suppliers_local()), 6, "avg_quality", "avg_availability_pct")


@_query
def supplier_top10(lake: Lake) -> DataFrame:
    return serving.supplier_top10(lake.suppliers_local())


@_query
def supplier_quadrants(lake: Lake) -> DataFrame:
    return serving.supplier_quadrants(lake.suppliers_local())
