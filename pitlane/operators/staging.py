"""Staging views over silver: casts, trims and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.functions import first_threshold


def _trimmed(*names: str) -> list[Column]:
    return [F.trim(n).alias(n) for n in names]


def _ingested() -> list[Column]:
    return [F.col(n).cast("int").alias(n) for n in ("ingested_year", "ingested_month")]


def _below(c: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    label = None
    for bound, name in steps:
        label = F.when(c < bound, name) if label is None else label.when(c < bound, name)
    return label.otherwise(otherwise)


def stg_parts(silver: DataFrame) -> DataFrame:
    """``is_available`` is three-valued: neither in stock nor discontinued is unknown."""
    price = F.col("price_eur")
    # Price tiers and the prices they end at.
    tier = _below(price, [(5, "very_low"), (50, "low"), (200, "medium"), (500, "high")], "premium")
    return silver.where(
        F.col("part_id").isNotNull() & F.col("part_number").isNotNull() & (F.col("part_number") != "")
    ).select(
        "part_id", "part_number",
        *_trimmed("brand", "brand_type", "category", "sub_category"),
        "description",
        price.cast("double").alias("price_eur"),
        F.col("stock_quantity").cast("int").alias("stock_quantity"),
        F.lower(F.trim("availability")).alias("availability"),
        "supplier",
        F.lower(F.trim("source")).alias("source"),
        F.col("quality_score").cast("double").alias("quality_score"),
        "_fingerprint",
        *_ingested(),
        F.when(F.col("availability") == "in_stock", True)
        .when(F.col("availability") == "discontinued", False).alias("is_available"),
        F.when(price.isNull(), "missing_price").otherwise(tier).alias("price_tier"),
    )


def stg_listings(silver: DataFrame) -> DataFrame:
    """A sale within seven days, the seventh included, is fast."""
    asking = F.col("asking_price_eur")
    return silver.where(
        F.col("listing_id").isNotNull() & (asking > 0) & (asking < 10000)
    ).select(
        "listing_id", "part_number",
        *_trimmed("brand", "category", "vehicle_make", "vehicle_model"),
        F.col("vehicle_year").cast("int").alias("vehicle_year"),
        *[F.col(n).cast("double").alias(n) for n in ("asking_price_eur", "negotiated_price_eur", "discount_rate")],
        F.lower(F.trim("seller_type")).alias("seller_type"),
        *_trimmed("seller_region"),
        F.lower(F.trim("condition")).alias("condition"),
        F.col("days_to_sell").cast("int").alias("days_to_sell"),
        "source",
        *_ingested(),
        F.coalesce(F.col("days_to_sell") <= 7, F.lit(False)).alias("is_fast_sale"),
        # Price segments and the prices they end at.
        _below(
            asking, [(30, "entrée de gamme"), (100, "milieu de gamme"), (300, "premium")], "haut de gamme"
        ).alias("price_segment"),
    )


# Component class -> words that mark it, first class wins.
COMPONENT_CLASSES = {
    "Freinage": ("brake", "frein"),
    "Moteur": ("engine", "moteur"),
    "Direction": ("steering", "direction"),
    "Sécurité passive": ("airbag", "restraint"),
    "Alimentation": ("fuel", "carburant"),
}

# Vehicles affected -> severity.
SEVERITIES = [(100000, "critique"), (10000, "majeur"), (1000, "modéré")]


def component_category(component: Column) -> Column:
    text = F.lower(component)
    label = None
    for name, words in COMPONENT_CLASSES.items():
        hit = text.contains(words[0]) | text.contains(words[1])
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise("Autre")


def stg_recalls(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("recall_id").isNotNull() & (F.col("recall_id") != "")).select(
        "recall_id",
        F.upper(F.trim("make")).alias("vehicle_make"),
        F.trim("model").alias("vehicle_model"),
        F.col("model_year").cast("int").alias("model_year"),
        *_trimmed("manufacturer", "component"),
        "summary", "remedy",
        F.col("potentially_affected").cast("int").alias("potentially_affected"),
        "source",
        *_ingested(),
        component_category(F.col("component")).alias("component_category"),
        first_threshold("potentially_affected", SEVERITIES, "mineur").alias("severity"),
    )
