"""Data-quality checks. They report failures and never filter or raise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns and values checked per staging model.
NOT_NULL = {
    "stg_parts_catalog": ["part_id", "part_number", "price_eur"],
    "stg_market_listings": ["listing_id", "asking_price_eur"],
    "stg_vehicle_recalls": ["recall_id"],
}
UNIQUE = {"stg_parts_catalog": "part_id", "stg_market_listings": "listing_id", "stg_vehicle_recalls": "recall_id"}
ACCEPTED = {
    "stg_parts_catalog": {
        "availability": ["in_stock", "on_order", "discontinued"],
        "brand_type": ["OEM", "COMPAT"],
    },
    "stg_market_listings": {"condition": ["new", "reconditioned", "used"]},
    "stg_vehicle_recalls": {"severity": ["critique", "majeur", "modéré", "mineur"]},
}


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def dq_not_null(models: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """One row per (model, column) with the number of nulls; one pass per model."""
    reports = []
    for model, (df, columns) in models.items():
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        reports.append(counts.unpivot([], columns, "column", "failures").select(
            F.lit(model).alias("model"), "column", F.lit("not_null").alias("test"), "failures"))
    return _stack(reports)


def dq_unique(df: DataFrame, key: str) -> DataFrame:
    """Duplicated non-null keys and how often they occur."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def dq_accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list and how often they occur; nulls pass."""
    return (
        df.where(~F.col(column).isin(values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def dq_report(staging: dict[str, DataFrame]) -> DataFrame:
    """All declared checks of the staging models: failures per (model, column, test).

    One pass per model counts nulls and distinct unaccepted values; unique keys
    take one grouping.
    """
    reports = []
    for model, df in staging.items():
        checks = {("not_null", c): F.count_if(F.col(c).isNull()) for c in NOT_NULL[model]}
        for column, values in ACCEPTED[model].items():
            outside = F.when(~F.col(column).isin(values), F.col(column))
            checks["accepted_values", column] = F.count_distinct(outside)
        names = [f"{test}:{column}" for test, column in checks]
        counted = df.agg(*[c.cast("long").alias(n) for c, n in zip(checks.values(), names)])
        reports.append(counted.unpivot([], names, "check", "failures").select(
            F.lit(model).alias("model"), F.split_part("check", F.lit(":"), F.lit(2)).alias("column"),
            F.split_part("check", F.lit(":"), F.lit(1)).alias("test"), "failures",
        ))
        key = UNIQUE[model]
        reports.append(dq_unique(df, key).agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(model).alias("model"), F.lit(key).alias("column"), F.lit("unique").alias("test"), "failures"
        ))
    return _stack(reports)


def dq_no_negative_prices(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.count_if(F.col("price_eur") < 0).alias("failures"))


def dq_reliability_bounded(enriched: DataFrame) -> DataFrame:
    score = F.col("reliability_score")
    return enriched.agg(F.count_if((score < 0) | (score > 1)).alias("failures"))


def dq_gold_validate(pricing: DataFrame, coverage: DataFrame) -> DataFrame:
    """Invariants of the built marts; the pipeline raises if any count is positive."""
    score = F.col("coverage_score_pct")
    negative = pricing.agg(F.count_if(F.col("catalog_median_price") < 0).alias("failures"))
    outside = coverage.agg(F.count_if((score < 0) | (score > 100)).alias("failures"))
    return _stack([
        negative.select(F.lit("negative_median_price").alias("check"), "failures"),
        outside.select(F.lit("coverage_score_out_of_bounds").alias("check"), "failures"),
    ])
