"""The medallion tables over one folder of base tables, built on first use.

Raw collections are lazy mappings. Silver, the enriched catalogue and the gold
marts are stored, as they are in a scheduled run, and shared by all queries of
an application.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.operators import enrich, marts, marts_local, silver, silver_local, staging
from pitlane.sources import bronze, shared, starmap, tables

_LAKES: dict[tuple[str, str], Lake] = {}


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._stored: dict[str, DataFrame] = {}
        self._ran: dict[str, str] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Lake:
        return _LAKES.setdefault((spark.sparkContext.applicationId, sf_dir), cls(spark, sf_dir))

    def _store(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._stored:
            self._stored[name] = shared.store(build(), name)
        return self._stored[name]

    def once(self, name: str, run: Callable[[], str]) -> str:
        """Where a job wrote its tables; it runs for the first query that reads one of them."""
        if name not in self._ran:
            self._ran[name] = run()
        return self._ran[name]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def path(self, name: str) -> str:
        return shared.new_path(self.spark, name)

    # bronze

    def raw(self, collection: str) -> DataFrame:
        return starmap.RAW[collection](self.spark, self.sf_dir)

    def placed(self, collection: str) -> DataFrame:
        """A raw collection on its way into silver."""
        return starmap.placed(self.spark, self.sf_dir, collection)

    def raw_flat(self, collection: str) -> DataFrame:
        """The single-machine bronze table on its way into silver: no internal columns, nested ones as JSON text."""
        return bronze.bronze_nested_to_json(bronze.bronze_drop_internal(self.placed(collection)))

    def events(self) -> DataFrame:
        return starmap.raw_events(self.spark, self.sf_dir)

    # silver

    def silver(self, dataset: str) -> DataFrame:
        return self._store(f"silver_{dataset}", lambda: silver.CLEANERS[dataset](self.placed(dataset)))

    def write_silver(self, dataset: str, path: str) -> None:
        """Silver as a table by months; if it is not stored yet, that one serves all queries and no other is written."""
        name = f"silver_{dataset}"
        rows = self._stored[name] if name in self._stored else silver.CLEANERS[dataset](self.placed(dataset))
        tables.silver_write_partitioned(rows, path)
        self._stored.setdefault(name, tables.scan_parquet(self.spark, path, rows.schema))

    def silver_parts_local(self) -> DataFrame:
        return self._store(
            "silver_parts_local", lambda: silver_local.silver_parts_local(self.raw_flat("parts_catalog"))
        )

    def silver_listings_local(self) -> DataFrame:
        return self._store(
            "silver_listings_local", lambda: silver_local.silver_listings_local(self.raw_flat("market_listings"))
        )

    # staging and enrichment

    def stg_parts(self) -> DataFrame:
        return staging.stg_parts(self.silver("parts_catalog"))

    def stg_listings(self) -> DataFrame:
        return staging.stg_listings(self.silver("market_listings"))

    def stg_recalls(self) -> DataFrame:
        return staging.stg_recalls(self.silver("vehicle_recalls"))

    def staging(self) -> dict[str, DataFrame]:
        return {
            "stg_parts_catalog": self.stg_parts(),
            "stg_market_listings": self.stg_listings(),
            "stg_vehicle_recalls": self.stg_recalls(),
        }

    def all_quotes(self) -> DataFrame:
        """Cleaned catalogue rows from before the deduplication."""
        return staging.stg_parts(silver.clean_parts(self.raw("parts_catalog")))

    def price_stats(self) -> DataFrame:
        return self._store("int_price_stats", lambda: enrich.int_price_stats(self.stg_parts()))

    def enriched(self) -> DataFrame:
        return self._store(
            "int_parts_enriched",
            lambda: enrich.int_parts_enriched(self.stg_parts(), price_stats=self.price_stats()),
        )

    def enriched_multisource(self) -> DataFrame:
        return self._store(
            "int_parts_enriched_multisource",
            lambda: enrich.int_parts_enriched(self.stg_parts(), self.all_quotes(), self.price_stats()),
        )

    # gold

    def pricing(self) -> DataFrame:
        return self._store(
            "mart_market_pricing", lambda: marts.mart_market_pricing(self.enriched(), self.stg_listings())
        )

    def pricing_local(self) -> DataFrame:
        return self._store(
            "mart_market_pricing_local",
            lambda: marts_local.mart_market_pricing_local(self.silver_parts_local(), self.silver_listings_local()),
        )

    def coverage_local(self) -> DataFrame:
        return self._store(
            "mart_catalog_coverage_local",
            lambda: marts_local.mart_catalog_coverage_local(self.silver_listings_local()),
        )

    def suppliers_local(self) -> DataFrame:
        return self._store(
            "mart_supplier_performance_local",
            lambda: marts_local.mart_supplier_performance_local(self.silver_parts_local()),
        )

    # feeds

    def documents(self, collection: str) -> DataFrame:
        """A raw collection with a typed ``ingested_at``, as the merge compares it."""
        return self.raw(collection).withColumn("ingested_at", F.try_to_timestamp("ingested_at"))
