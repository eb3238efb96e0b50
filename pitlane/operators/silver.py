"""Bronze to silver: typed, trimmed, bounded and one row per business key."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane import schemas as S
from pitlane.functions import between_or_null, clamp_unit, parse_ts, rnd
from pitlane.operators.dedup import content_order, latest_by

_TS = "_ts"


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn(_TS, parse_ts("ingested_at"))


def _contract(df: DataFrame, columns: list[str], *derived: str) -> DataFrame:
    return df.select(
        *columns, *derived, F.year(_TS).alias("ingested_year"), F.month(_TS).alias("ingested_month")
    )


def clean_parts(df: DataFrame, null_quality: str = "perfect") -> DataFrame:
    """Row-level cleaning of the catalogue, before deduplication (all quotes of a part stay).

    An unknown quality score is clamped to 1.0; ``null_quality="keep"`` leaves it null.
    """
    price, stock, quality = F.col("price_eur"), F.col("stock_quantity"), F.col("quality_score")
    scored = clamp_unit(quality)
    if null_quality == "keep":
        scored = F.when(quality.isNotNull(), scored)
    cleaned = df.where(
        F.col("part_id").isNotNull() & F.col("part_number").isNotNull() & (F.col("part_number") != "")
    ).withColumns({
        "part_number": F.trim(F.upper("part_number")),
        "brand": F.trim(F.initcap("brand")),
        "category": F.trim("category"),
        "source": F.trim(F.lower("source")),
        "availability": F.trim(F.lower("availability")),
        "price_eur": between_or_null(price, (price > 0) & (price < 10000)),
        "stock_quantity": F.when(stock >= 0, stock).otherwise(F.lit(0)),
        "quality_score": scored,
    })
    return _contract(_dated(cleaned), S.SILVER_PARTS, _TS)


def dedup_parts(cleaned: DataFrame) -> DataFrame:
    """Latest quote per fingerprint."""
    return latest_by(cleaned, ["_fingerprint"], F.col(_TS), content_order(S.SILVER_PARTS)).drop(_TS)


def silver_parts(df: DataFrame, null_quality: str = "perfect") -> DataFrame:
    return dedup_parts(clean_parts(df, null_quality))


def _placed(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == S.PLACE]


def _keyed_recalls(df: DataFrame) -> DataFrame:
    return _dated(df.select(*S.SILVER_RECALLS, *_placed(df)).where(F.col("recall_id").isNotNull()))


def _cleaned_recalls(latest: DataFrame) -> DataFrame:
    year = F.col("model_year")
    cleaned = latest.withColumns({
        "make": F.trim(F.upper("make")),
        "model": F.trim(F.initcap("model")),
        "manufacturer": F.trim("manufacturer"),
        "component": F.trim("component"),
        "model_year": between_or_null(year, year.between(1980, 2025)),
    })
    return _contract(cleaned, S.SILVER_RECALLS)


def _keyed_listings(df: DataFrame) -> DataFrame:
    return _dated(df.select(*S.SILVER_LISTINGS, *_placed(df)).where(F.col("listing_id").isNotNull()))


def _cleaned_listings(latest: DataFrame) -> DataFrame:
    asking, negotiated = F.col("asking_price_eur"), F.col("negotiated_price_eur")
    cleaned = latest.where(asking > 0).withColumns({
        "vehicle_make": F.trim(F.initcap("vehicle_make")),
        "vehicle_model": F.trim("vehicle_model"),
        "brand": F.trim(F.initcap("brand")),
        "category": F.trim("category"),
        "condition": F.trim(F.lower("condition")),
        "seller_type": F.trim(F.lower("seller_type")),
        "discount_rate": rnd(F.lit(1.0) - F.try_divide(negotiated, asking), 4),
    })
    return _contract(cleaned, S.SILVER_LISTINGS, "discount_rate")


@dataclass(frozen=True)
class Dataset:
    """How a dataset becomes silver: rows that compete for their key, which of them survives, what is made of it."""

    key: str
    contract: list[str]
    candidates: Callable[[DataFrame], DataFrame]
    finished: Callable[[DataFrame], DataFrame]

    def survivors(self, candidates: DataFrame, *ties: Column) -> DataFrame:
        return latest_by(candidates, [self.key], F.col(_TS), [*content_order(self.contract), *ties])

    def silver(self, raw: DataFrame) -> DataFrame:
        return self.finished(self.survivors(self.candidates(raw)))


DATASETS = {
    # Cleaned before the deduplication, as the fingerprint alone tells what competes.
    "parts_catalog": Dataset("_fingerprint", S.SILVER_PARTS, clean_parts, lambda df: df.drop(_TS)),
    "vehicle_recalls": Dataset("recall_id", S.SILVER_RECALLS, _keyed_recalls, _cleaned_recalls),
    # Filtered on price after it: a listing whose latest version is unpriced is dropped.
    "market_listings": Dataset("listing_id", S.SILVER_LISTINGS, _keyed_listings, _cleaned_listings),
}


def silver_recalls(df: DataFrame) -> DataFrame:
    return DATASETS["vehicle_recalls"].silver(df)


def silver_listings(df: DataFrame) -> DataFrame:
    return DATASETS["market_listings"].silver(df)


CLEANERS = {
    "parts_catalog": silver_parts,
    "vehicle_recalls": silver_recalls,
    "market_listings": silver_listings,
}
