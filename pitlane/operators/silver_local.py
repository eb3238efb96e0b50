"""The single-machine pipeline's silver rules, where they differ from ``silver``.

Every bronze column stays, prices arrive as any type, text is stripped of all
whitespace and capitalised after every non-letter, and ``ingested_at`` becomes
a timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane import schemas as S
from pitlane.functions import between_or_null, parse_ts, rnd_even, strip_ws, title_case
from pitlane.operators.dedup import content_order, latest_by


def _stamped(df: DataFrame) -> DataFrame:
    ts = F.col("ingested_at")
    return df.withColumn("ingested_at", parse_ts("ingested_at")).withColumns(
        {"ingested_year": F.year(ts), "ingested_month": F.month(ts)}
    )


def silver_parts_local(df: DataFrame) -> DataFrame:
    """Blank part numbers go before the dedup; a price of exactly 10,000 stays."""
    price = F.col("price_eur")
    cleaned = (
        df.where(F.col("part_id").isNotNull() & (strip_ws("part_number") != ""))
        .withColumns({
            "part_number": F.upper(strip_ws("part_number")),
            "brand": title_case(strip_ws("brand")),
            "source": F.lower(strip_ws("source")),
            "availability": F.lower(strip_ws("availability")),
            "price_eur": price.try_cast("double"),
        })
        .withColumn("price_eur", between_or_null(price, (price > 0) & (price <= 10000)))
        .withColumn("is_available", F.coalesce(F.col("availability") == "in_stock", F.lit(False)))
    )
    ties = content_order([c for c in S.SILVER_PARTS if c not in ("_fingerprint", "ingested_at")])
    return latest_by(_stamped(cleaned), ["_fingerprint"], F.col("ingested_at"), ties)


def silver_listings_local(df: DataFrame, strip_category: bool = True) -> DataFrame:
    """The scheduled variant of this pipeline leaves the category as it is."""
    keyed = _stamped(df.where(F.col("listing_id").isNotNull()))
    ties = content_order([c for c in S.SILVER_LISTINGS if c not in ("listing_id", "ingested_at")])
    latest = latest_by(keyed, ["listing_id"], F.col("ingested_at"), ties)
    asking, negotiated = F.col("asking_price_eur"), F.col("negotiated_price_eur")
    return (
        latest.withColumns({
            "asking_price_eur": asking.try_cast("double"),
            "negotiated_price_eur": negotiated.try_cast("double"),
        })
        # NaN sorts above all numbers here, but is no price.
        .where((asking > 0) & ~F.isnan(asking))
        .withColumns({
            "vehicle_make": title_case(strip_ws("vehicle_make")),
            "brand": title_case(strip_ws("brand")),
            "category": strip_ws("category") if strip_category else F.col("category"),
            "condition": F.lower(strip_ws("condition")),
            "seller_type": F.lower(strip_ws("seller_type")),
            "discount_rate": rnd_even(F.try_divide(asking - negotiated, asking), 4),
            "is_fast_sale": F.coalesce(F.col("days_to_sell") <= 7, F.lit(False)),
        })
    )
