"""Queries behind the report pages.

They read the single-machine marts, whose quality column is
``avg_quality_score``; pass ``avg_reliability_score`` to use them on the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.operators.marts import TIERS

QUALITY = "avg_quality_score"


def _by_refs() -> list[Column]:
    return [F.col("nb_catalog_references").desc(), *[
        F.col(c).asc_nulls_first() for c in ("category", "brand", "brand_type")
    ]]


def kpi_overview(pricing: DataFrame, coverage: DataFrame, quality: str = QUALITY) -> DataFrame:
    """A null make counts as one make."""
    make = F.col("vehicle_make")
    makes = coverage.agg(
        (F.countDistinct(make) + F.max(make.isNull().cast("int"))).alias("n")
    ).select(F.coalesce("n", F.lit(0)).alias("n"))
    return pricing.agg(
        F.sum("nb_catalog_references").alias("catalog_references"),
        F.avg(quality).alias("avg_quality"),
        F.sum("nb_market_listings").alias("market_listings"),
    ).withColumn("vehicle_makes", makes.scalar())


def top_categories(pricing: DataFrame, n: int = 8) -> DataFrame:
    """The ``n`` largest rows with a known median, smallest median first."""
    known = pricing.where(F.col("catalog_median_price").isNotNull())
    return known.orderBy(*_by_refs()).limit(n).orderBy(
        "catalog_median_price", *[F.col(c).asc_nulls_first() for c in ("category", "brand", "brand_type")]
    )


def catalog_vs_market(pricing: DataFrame) -> DataFrame:
    """Rows with both medians, and the end of the axis they share."""
    both = pricing.na.drop(subset=["catalog_median_price", "market_median_price"])
    axis = both.agg(F.greatest(F.max("catalog_median_price"), F.max("market_median_price")).alias("m"))
    return both.withColumn("axis_max", axis.scalar())


def pricing_category_list(pricing: DataFrame) -> DataFrame:
    return pricing.select("category").na.drop().distinct().orderBy("category")


def pricing_by_category(pricing: DataFrame, category: str | None = None) -> DataFrame:
    """One category, or all; only those of the report's columns that the mart has."""
    wanted = ["category", "brand", "nb_catalog_references", "catalog_median_price",
              "market_median_price", "market_vs_catalog_pct", QUALITY]
    rows = pricing if category is None else pricing.where(F.col("category") == category)
    return rows.select(*[c for c in wanted if c in pricing.columns])


def pricing_long(pricing: DataFrame) -> DataFrame:
    """Catalogue and market median as two rows, dearest catalogue median first."""
    known = pricing.where(F.col("catalog_median_price").isNotNull())
    ids = ["category", "brand", "brand_type"]
    return (
        known.withColumn("_rank", F.col("catalog_median_price"))
        .unpivot([*ids, "_rank"], ["catalog_median_price", "market_median_price"], "price_source", "price")
        .orderBy(F.col("_rank").desc(), *[F.col(c).asc_nulls_first() for c in ids], "price_source")
        .drop("_rank")
    )


def liquidity_counts(pricing: DataFrame) -> DataFrame:
    return (
        pricing.where(F.col("market_liquidity").isNotNull())
        .groupBy("market_liquidity")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "market_liquidity")
    )


def coverage_top(coverage: DataFrame, n: int = 10, target: float = 80.0) -> DataFrame:
    order = [F.col("total_parts").desc(), *[F.col(c).asc_nulls_first() for c in ("vehicle_make", "vehicle_model")]]
    return coverage.orderBy(*order).limit(n).withColumn("meets_target", F.col("coverage_score_pct") >= target)


def coverage_vs_volume(coverage: DataFrame) -> DataFrame:
    return coverage.select("vehicle_make", "coverage_score_pct", "total_parts", "total_listings")


def supplier_kpis(suppliers: DataFrame, quality: str = QUALITY) -> DataFrame:
    return suppliers.agg(
        F.count_if(F.col("supplier_tier") == TIERS[0]).alias("tier_1_suppliers"),
        F.avg(quality).alias("avg_quality"),
        F.avg("availability_rate_pct").alias("avg_availability_pct"),
    )


def supplier_top10(suppliers: DataFrame, n: int = 10) -> DataFrame:
    ids = [F.col(c).asc_nulls_first() for c in ("supplier", "brand_type")]
    best = suppliers.orderBy(F.col("supplier_score").desc_nulls_last(), *ids).limit(n)
    return best.orderBy("supplier_score", *ids)


def supplier_quadrants(
    suppliers: DataFrame, quality_cut: float = 0.7, availability_cut: float = 70.0, quality: str = QUALITY
) -> DataFrame:
    reliable = F.when(F.col(quality) >= quality_cut, "reliable").otherwise("unreliable")
    available = F.when(F.col("availability_rate_pct") >= availability_cut, "available").otherwise("scarce")
    return (
        suppliers.groupBy(F.concat_ws("/", reliable, available).alias("quadrant"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("nb_unique_refs").alias("nb_unique_refs"))
    )
