"""Catalogue enrichment: price statistics, source coverage, outliers, reliability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.functions import rnd
from pitlane.operators.lookup import spread_lookup
from pitlane.operators.quantiles import aggregate_with_quantiles

STATS_KEYS = ["category", "brand_type"]
OUTLIER_THRESHOLD = 5.0


def int_price_stats(catalog: DataFrame, **quantile_options) -> DataFrame:
    """Quartiles, mean, deviation and count of known prices per category and brand type."""
    moments = [
        F.avg("price_eur").alias("avg_price"),
        F.stddev_samp("price_eur").alias("stddev_price"),
        F.count(F.lit(1)).alias("parts_count"),
    ]
    return aggregate_with_quantiles(
        catalog.where(F.col("price_eur").isNotNull()), STATS_KEYS, moments, "price_eur",
        {"q1": 0.25, "median_price": 0.5, "q3": 0.75}, spread_by=["part_id"], **quantile_options,
    ).select(*STATS_KEYS, "q1", "median_price", "q3", "avg_price", "stddev_price", "parts_count")


def _set_size(column: str) -> Column:
    return F.size(F.collect_set(column)).cast("long")


def int_source_coverage(catalog: DataFrame) -> DataFrame:
    """Sources and suppliers are counted as sets, which their vocabularies bound.

    Two distinct counts would write each row three times and shuffle all
    of them; a set leaves one row of a fingerprint in each map task.
    """
    low, high = F.col("min_price"), F.col("max_price")
    return (
        catalog.where(F.col("_fingerprint").isNotNull())
        .groupBy("_fingerprint")
        .agg(
            _set_size("source").alias("nb_sources"),
            _set_size("supplier").alias("nb_suppliers"),
            F.min("price_eur").alias("min_price"),
            F.max("price_eur").alias("max_price"),
            F.avg("price_eur").alias("avg_price_cross_source"),
        )
        .withColumn("price_spread_ratio", F.when(low > 0, rnd((high - low) / low, 4)))
    )


def int_price_outlier(price: Column, q1: Column, q3: Column, threshold: float = OUTLIER_THRESHOLD) -> Column:
    """Outside the quartiles by more than ``threshold`` times their distance; unknown is no outlier."""
    reach = F.lit(threshold) * (q3 - q1)
    return F.coalesce((price < q1 - reach) | (price > q3 + reach), F.lit(False))


def int_reliability_score(nb_sources: Column, quality: Column, spread: Column) -> Column:
    """Weighted sum of source count (saturating at three), raw quality and price coherence."""
    coherence = (
        F.when(spread.isNull() | (spread < 0.05), F.lit(0.25)).when(spread < 0.15, F.lit(0.15)).otherwise(F.lit(0.05))
    )
    return F.least(nb_sources / F.lit(3.0), F.lit(1.0)) * 0.40 + quality * 0.35 + coherence


def int_parts_enriched(
    catalog: DataFrame,
    coverage_input: DataFrame | None = None,
    price_stats: DataFrame | None = None,
    threshold: float = OUTLIER_THRESHOLD,
) -> DataFrame:
    """Catalogue rows with their category's price statistics and their sources.

    Silver keeps one row per fingerprint, so counting sources over the
    catalogue itself always yields one. Pass the cleaned rows from before the
    deduplication as ``coverage_input`` for a count over all quotes.
    ``price_stats`` takes an already stored ``int_price_stats`` of the catalogue.
    """
    stats = int_price_stats(catalog) if price_stats is None else price_stats
    stats = stats.select(
        *STATS_KEYS,
        F.col("median_price").alias("category_median_price"),
        F.col("avg_price").alias("category_avg_price"),
        F.col("q1").alias("category_q1"),
        F.col("q3").alias("category_q3"),
        F.col("parts_count").alias("category_parts_count"),
    )
    coverage = int_source_coverage(catalog if coverage_input is None else coverage_input).select(
        "_fingerprint", "nb_sources", "nb_suppliers", "price_spread_ratio"
    )
    price, median = F.col("price_eur"), F.col("category_median_price")
    priced = spread_lookup(catalog, stats, STATS_KEYS, F.col("part_id"))
    # One row per fingerprint, so few repeats: they only make the join one that adaptive execution can split.
    joined = spread_lookup(priced, coverage, ["_fingerprint"], F.col("part_id"), spread=4)
    return (
        joined.withColumns({
            "nb_sources": F.coalesce("nb_sources", F.lit(1)),
            "nb_suppliers": F.coalesce("nb_suppliers", F.lit(1)),
        })
        .select(
            *catalog.columns,
            "category_median_price", "category_avg_price", "category_q1", "category_q3", "category_parts_count",
            int_price_outlier(price, F.col("category_q1"), F.col("category_q3"), threshold).alias("is_price_outlier"),
            F.when(median > 0, rnd(price / median, 4)).alias("price_vs_median_ratio"),
            "nb_sources", "nb_suppliers", "price_spread_ratio",
            rnd(
                int_reliability_score(F.col("nb_sources"), F.col("quality_score"), F.col("price_spread_ratio")), 4
            ).alias("reliability_score"),
        )
    )
