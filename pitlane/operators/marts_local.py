"""The single-machine pipeline's marts, over ``silver_*_local``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.functions import ratio_pct, rnd
from pitlane.operators.marts import (
    PRICING_KEYS, SUPPLIER_KEYS, TIERS, VEHICLE_KEYS, coverage_level, market_liquidity, price_gap_pct,
)
from pitlane.operators.quantiles import aggregate_with_quantiles


def mart_market_pricing_local(parts: DataFrame, listings: DataFrame, **quantile_options) -> DataFrame:
    catalog_keys = [*PRICING_KEYS, "brand_type"]
    catalog = aggregate_with_quantiles(
        parts.where(F.col("price_eur").isNotNull()),
        catalog_keys,
        [
            F.count(F.lit(1)).alias("nb_references"),
            F.count_if("is_available").alias("nb_available"),
            rnd(F.avg("price_eur"), 2).alias("catalog_avg_price"),
            rnd(F.min("price_eur"), 2).alias("catalog_min_price"),
            rnd(F.max("price_eur"), 2).alias("catalog_max_price"),
            rnd(F.avg("quality_score"), 3).alias("avg_quality_score"),
        ],
        "price_eur", {"catalog_median": 0.5}, spread_by=["part_id"], **quantile_options,
    )
    market = aggregate_with_quantiles(
        listings,
        PRICING_KEYS,
        [
            F.count(F.lit(1)).alias("nb_listings"),
            rnd(F.avg("asking_price_eur"), 2).alias("market_avg_asking"),
            rnd(F.avg("discount_rate") * 100, 2).alias("avg_discount_pct"),
            rnd(F.avg("days_to_sell"), 1).alias("avg_days_to_sell"),
            F.count_if("is_fast_sale").alias("nb_fast_sales"),
        ],
        "asking_price_eur", {"market_median": 0.5}, spread_by=["listing_id"], **quantile_options,
    )
    zero = {"nb_references": "nb_catalog_references", "nb_available": "nb_catalog_available",
            "nb_listings": "nb_market_listings", "nb_fast_sales": "nb_fast_sales"}
    counts = {new: F.coalesce(F.col(old), F.lit(0)).alias(new) for old, new in zero.items()}
    return (
        catalog.join(market, PRICING_KEYS, "full")
        .withColumns({
            "catalog_median_price": rnd("catalog_median", 2),
            "market_median_price": rnd("market_median", 2),
        })
        .select(
            *catalog_keys,
            counts["nb_catalog_references"], counts["nb_catalog_available"],
            "catalog_avg_price", "catalog_median_price", "catalog_min_price", "catalog_max_price",
            "avg_quality_score",
            counts["nb_market_listings"],
            "market_avg_asking", "market_median_price", "avg_discount_pct", "avg_days_to_sell",
            counts["nb_fast_sales"],
            price_gap_pct().alias("market_vs_catalog_pct"),
            market_liquidity().alias("market_liquidity"),
        )
    )


def mart_catalog_coverage_local(listings: DataFrame, n_categories: int = 7) -> DataFrame:
    per_category = listings.groupBy(*VEHICLE_KEYS, "vehicle_year", "category").agg(
        F.countDistinct("part_number").alias("nb_distinct_parts"),
        F.count(F.lit(1)).alias("nb_listings"),
        rnd(F.avg("asking_price_eur"), 2).alias("avg_price"),
    )
    return (
        per_category.groupBy(*VEHICLE_KEYS)
        .agg(
            F.countDistinct("vehicle_year").alias("years_covered"),
            F.countDistinct("category").alias("categories_covered"),
            F.sum("nb_distinct_parts").alias("total_parts"),
            F.sum("nb_listings").alias("total_listings"),
            rnd(F.avg("avg_price"), 2).alias("global_avg_price"),
        )
        .withColumn("coverage_score_pct", rnd(F.col("categories_covered") * F.lit(100.0) / n_categories, 1))
        .withColumn("coverage_level", coverage_level(F.col("coverage_score_pct")))
    )


def mart_supplier_performance_local(parts: DataFrame) -> DataFrame:
    """Scores by quality alone; the second tier asks for no availability."""
    quality, rate = F.col("_quality"), F.col("_available") * F.lit(100.0) / F.col("_rows")
    return (
        parts.where(F.col("supplier").isNotNull())
        .groupBy(*SUPPLIER_KEYS)
        .agg(
            F.countDistinct("part_number").alias("nb_unique_refs"),
            F.countDistinct("category").alias("nb_categories"),
            F.countDistinct("brand").alias("nb_brands"),
            F.avg("price_eur").alias("_price"),
            # Ten decimals: the tier must not hang on the order in which doubles were summed.
            rnd(F.avg("quality_score"), 10).alias("_quality"),
            F.count_if("is_available").alias("_available"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .select(
            *SUPPLIER_KEYS, "nb_unique_refs", "nb_categories", "nb_brands",
            rnd("_price", 2).alias("avg_price"),
            rnd(quality, 3).alias("avg_quality_score"),
            F.col("_available").alias("nb_available_refs"),
            ratio_pct(F.col("_available"), F.col("_rows")).alias("availability_rate_pct"),
            F.when((quality >= 0.8) & (rate >= 80), TIERS[0])
            .when(quality >= 0.6, TIERS[1])
            .when(quality >= 0.4, TIERS[2])
            .otherwise(TIERS[3]).alias("supplier_tier"),
            rnd(quality * 100, 1).alias("supplier_score"),
        )
    )
