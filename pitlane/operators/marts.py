"""The four gold marts and the grouped tables they are made of.

Marts carry no ``updated_at`` (``gold_materialize`` adds it) and no order (a
stored table has none; ``gold_read_mart`` sorts on reading).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.functions import first_threshold, ratio_pct, rnd
from pitlane.operators.quantiles import aggregate_with_quantiles


def _rows() -> Column:
    return F.count(F.lit(1))


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


# --- market pricing ---------------------------------------------------------

PRICING_KEYS = ["category", "brand"]


def pricing_catalog_side(enriched: DataFrame, **quantile_options) -> DataFrame:
    return aggregate_with_quantiles(
        enriched.where(F.col("price_eur").isNotNull()),
        [*PRICING_KEYS, "brand_type"],
        [
            _rows().alias("nb_references"),
            F.count_if("is_available").alias("nb_available"),
            rnd(F.avg("price_eur"), 2).alias("catalog_avg_price"),
            rnd(F.min("price_eur"), 2).alias("catalog_min_price"),
            rnd(F.max("price_eur"), 2).alias("catalog_max_price"),
            rnd(F.avg("reliability_score"), 3).alias("avg_reliability_score"),
            F.count_if("is_price_outlier").alias("nb_price_outliers"),
            F.count_if(F.col("nb_sources") >= 2).alias("nb_multi_source_refs"),
        ],
        "price_eur", {"catalog_median_price": 0.5}, spread_by=["part_id"], **quantile_options,
    ).withColumn("catalog_median_price", rnd("catalog_median_price", 2))


def pricing_market_side(listings: DataFrame, **quantile_options) -> DataFrame:
    return aggregate_with_quantiles(
        listings,
        PRICING_KEYS,
        [
            _rows().alias("nb_listings"),
            rnd(F.avg("asking_price_eur"), 2).alias("market_avg_asking"),
            rnd(F.avg("negotiated_price_eur"), 2).alias("market_avg_negotiated"),
            rnd(F.avg("discount_rate") * 100, 2).alias("avg_discount_pct"),
            rnd(F.avg("days_to_sell"), 1).alias("avg_days_to_sell"),
            F.count_if("is_fast_sale").alias("nb_fast_sales"),
            F.count_if(F.col("condition") == "new").alias("nb_new_condition"),
            F.count_if(F.col("condition") == "reconditioned").alias("nb_reconditioned"),
        ],
        "asking_price_eur", {"market_median_price": 0.5}, spread_by=["listing_id"], **quantile_options,
    ).withColumn("market_median_price", rnd("market_median_price", 2))


def price_gap_pct() -> Column:
    catalog, market = F.col("catalog_median_price"), F.col("market_median_price")
    return F.when((catalog > 0) & (market > 0), rnd((market - catalog) / catalog * 100, 2))


def market_liquidity() -> Column:
    # Labels of liquidity and the days they end at.
    return first_threshold("avg_days_to_sell", [(7, "haute"), (21, "moyenne")], "faible", at_least=False)


def mart_market_pricing(enriched: DataFrame, listings: DataFrame, **quantile_options) -> DataFrame:
    """Catalogue against market prices. Market figures repeat for each brand type of a brand."""
    joined = pricing_catalog_side(enriched, **quantile_options).join(
        pricing_market_side(listings, **quantile_options), PRICING_KEYS, "full"
    )
    return joined.select(
        *PRICING_KEYS, "brand_type",
        _zero("nb_references").alias("nb_catalog_references"),
        _zero("nb_available").alias("nb_catalog_available"),
        "catalog_avg_price", "catalog_median_price", "catalog_min_price", "catalog_max_price",
        "avg_reliability_score",
        _zero("nb_price_outliers").alias("nb_catalog_price_outliers"),
        _zero("nb_multi_source_refs").alias("nb_multi_source_refs"),
        _zero("nb_listings").alias("nb_market_listings"),
        "market_avg_asking", "market_avg_negotiated", "market_median_price",
        "avg_discount_pct", "avg_days_to_sell",
        _zero("nb_fast_sales").alias("nb_fast_sales"),
        price_gap_pct().alias("market_vs_catalog_pct"),
        market_liquidity().alias("market_liquidity"),
    )


# --- catalogue coverage -----------------------------------------------------

VEHICLE_KEYS = ["vehicle_make", "vehicle_model"]
# Labels of coverage and the scores they begin at.
COVERAGE_LEVELS = [(85, "couverture complète"), (60, "bonne couverture"), (40, "couverture partielle")]


def coverage_level(score: Column) -> Column:
    return first_threshold(score, COVERAGE_LEVELS, "couverture faible")


def _set_size(column: str) -> Column:
    return F.size(F.collect_set(column)).cast("long")


def _distinct(column: str, approx_rsd: float | None) -> Column:
    """Exact, or opted into a sketch of the given relative deviation, which needs no row per distinct value."""
    return F.countDistinct(column) if approx_rsd is None else F.approx_count_distinct(column, approx_rsd)


def coverage_by_vehicle(listings: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """Listings serve as a proxy of the catalogue, which knows no vehicles.

    Brands are counted as a set, which their vocabulary bounds, so that parts
    are the only distinct count and rows need not be multiplied for a second.
    """
    is_new = F.col("condition") == "new"
    return listings.groupBy(*VEHICLE_KEYS, "vehicle_year", "category").agg(
        _distinct("part_number", approx_rsd).alias("nb_distinct_parts"),
        _rows().alias("nb_listings"),
        rnd(F.avg("asking_price_eur"), 2).alias("avg_price"),
        _set_size("brand").alias("nb_brands"),
        F.count_if(is_new).alias("nb_new_parts"),
        ratio_pct(F.count_if(is_new), _rows()).alias("new_parts_pct"),
    )


def coverage_totals(by_vehicle: DataFrame, n_categories: int = 7) -> DataFrame:
    """Sums distinct parts over years and categories, of which there are few, and averages rounded averages."""
    return by_vehicle.groupBy(*VEHICLE_KEYS).agg(
        _set_size("vehicle_year").alias("years_covered"),
        _set_size("category").alias("categories_covered"),
        F.sum("nb_distinct_parts").alias("total_parts"),
        F.sum("nb_listings").alias("total_listings"),
        rnd(F.avg("avg_price"), 2).alias("global_avg_price"),
        rnd(F.avg("nb_brands"), 1).alias("avg_brands_per_category"),
    ).withColumn("coverage_score_pct", rnd(F.col("categories_covered") * F.lit(100.0) / n_categories, 1))


def recalls_by_vehicle(recalls: DataFrame) -> DataFrame:
    return recalls.groupBy(*VEHICLE_KEYS).agg(
        _rows().alias("total_recalls"),
        F.sum("potentially_affected").alias("total_vehicles_affected"),
        F.count_if(F.col("severity") == "critique").alias("critical_recalls"),
        F.countDistinct("component_category").alias("affected_component_categories"),
    )


def _same_vehicle(a: DataFrame, b: DataFrame, pairs: list[tuple[str, str]], normalize: bool) -> Column:
    condition = None
    for left, right in pairs:
        x, y = a[left], b[right]
        if normalize:
            x, y = F.upper(F.trim(x)), F.upper(F.trim(y))
        condition = (x == y) if condition is None else condition & (x == y)
    return condition


def _regroup_recalls_by_normal_key(recalls: DataFrame) -> DataFrame:
    return recalls.withColumns({k: F.upper(F.trim(k)) for k in VEHICLE_KEYS})


def mart_catalog_coverage(
    listings: DataFrame, recalls: DataFrame, n_categories: int = 7, normalize_keys: bool = False
) -> DataFrame:
    """Coverage per vehicle and the recalls that meet it.

    Recall makes are upper case and listing makes capitalised, so the literal
    keys hardly ever meet; ``normalize_keys`` compares them without case.
    """
    totals = coverage_totals(coverage_by_vehicle(listings), n_categories)
    if normalize_keys:
        recalls = _regroup_recalls_by_normal_key(recalls)
    by_vehicle = recalls_by_vehicle(recalls).withColumnsRenamed({k: f"r_{k}" for k in VEHICLE_KEYS})
    match = _same_vehicle(totals, by_vehicle, [(k, f"r_{k}") for k in VEHICLE_KEYS], normalize_keys)
    score = F.col("coverage_score_pct")
    return (
        totals.join(by_vehicle, match, "left")
        .withColumn("total_recalls", _zero("total_recalls"))
        .select(
            *totals.columns,
            "total_recalls",
            _zero("total_vehicles_affected").alias("vehicles_affected_by_recalls"),
            _zero("critical_recalls").alias("critical_recalls"),
            _zero("affected_component_categories").alias("recall_component_categories"),
            coverage_level(score).alias("coverage_level"),
            ((score < 60) & (F.col("total_recalls") > 0)).alias("is_coverage_opportunity"),
        )
    )


# --- supplier performance ---------------------------------------------------

SUPPLIER_KEYS = ["supplier", "brand_type"]


def supplier_catalog_perf(enriched: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """Categories and brands are counted as sets, which their vocabularies bound."""
    multi_source = F.col("nb_sources") >= 2
    return enriched.where(F.col("supplier").isNotNull()).groupBy(*SUPPLIER_KEYS).agg(
        _distinct("part_number", approx_rsd).alias("nb_unique_refs"),
        _set_size("category").alias("nb_categories"),
        _set_size("brand").alias("nb_brands"),
        rnd(F.avg("price_eur"), 2).alias("avg_price"),
        rnd(F.avg("reliability_score"), 3).alias("avg_reliability_score"),
        F.count_if("is_available").alias("nb_available_refs"),
        F.count_if("is_price_outlier").alias("nb_price_outliers"),
        F.count_if(multi_source).alias("nb_validated_by_multi_source"),
        ratio_pct(F.count_if("is_available"), _rows()).alias("availability_rate_pct"),
        ratio_pct(F.count_if(multi_source), _rows()).alias("multi_source_validation_pct"),
    )


def seller_market_perf(listings: DataFrame) -> DataFrame:
    return listings.groupBy(F.col("seller_type").alias("supplier_type"), "seller_region").agg(
        _rows().alias("nb_transactions"),
        rnd(F.avg("asking_price_eur"), 2).alias("avg_asking_price"),
        rnd(F.avg("discount_rate") * 100, 2).alias("avg_discount_pct"),
        rnd(F.avg("days_to_sell"), 1).alias("avg_days_to_sell"),
        ratio_pct(F.count_if("is_fast_sale"), _rows()).alias("fast_sale_rate_pct"),
        F.countDistinct("vehicle_make").alias("nb_vehicle_makes_covered"),
        F.countDistinct("category").alias("nb_categories_covered"),
    )


# Tier names.
TIERS = ("Tier 1 — Stratégique", "Tier 2 — Fiable", "Tier 3 — À surveiller", "Tier 4 — Risqué")


def mart_supplier_performance(enriched: DataFrame) -> DataFrame:
    """The weights already reach 100 and the sum is multiplied by 100, so the score runs to 10,000."""
    reliability, available = F.col("avg_reliability_score"), F.col("availability_rate_pct")
    outliers = F.col("nb_price_outliers")
    outlier_share = F.try_divide(outliers.cast("double"), F.col("nb_unique_refs").cast("double"))
    outlier_points = F.when(outliers == 0, 10).when(outlier_share < 0.02, 7).when(outlier_share < 0.05, 4).otherwise(0)
    score = (
        F.least(available / 100.0, F.lit(1.0)) * 35
        + reliability * 35
        + F.least(F.col("multi_source_validation_pct") / 100.0, F.lit(1.0)) * 20
        + outlier_points
    ) * 100
    return supplier_catalog_perf(enriched).withColumns({
        "supplier_score": rnd(score, 1),
        "supplier_tier": F.when((reliability >= 0.8) & (available >= 80), TIERS[0])
        .when((reliability >= 0.6) & (available >= 60), TIERS[1])
        .when(reliability >= 0.4, TIERS[2])
        .otherwise(TIERS[3]),
    })


# --- recall impact ----------------------------------------------------------


def recall_summary(recalls: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """Models and years are counted as sets, which a maker's range bounds."""
    return recalls.groupBy("vehicle_make", "component_category", "severity").agg(
        _distinct("recall_id", approx_rsd).alias("nb_recalls"),
        F.sum("potentially_affected").alias("total_vehicles_affected"),
        _set_size("vehicle_model").alias("nb_models_affected"),
        _set_size("model_year").alias("nb_years_affected"),
    )


def recall_parts_availability(listings: DataFrame) -> DataFrame:
    return (
        listings.where(F.col("condition").isin("new", "reconditioned"))
        .groupBy("vehicle_make", F.col("category").alias("component_category"))
        .agg(
            F.countDistinct("part_number").alias("nb_parts_available"),
            rnd(F.avg("asking_price_eur"), 2).alias("avg_part_price"),
            F.countDistinct("brand").alias("nb_brands_available"),
        )
    )


# Severity -> (share of owners who buy a part, price assumed where none is known).
MARKET_POTENTIAL = {"critique": (0.80, 100.0), "majeur": (0.60, 80.0)}
MARKET_POTENTIAL_OTHER = (0.30, 50.0)


def mart_recall_impact(recalls: DataFrame, listings: DataFrame, normalize_keys: bool = False) -> DataFrame:
    """Recalls against the parts on offer for them, with an estimate of the demand."""
    keys = ["vehicle_make", "component_category"]
    if normalize_keys:
        listings = listings.withColumns({"vehicle_make": F.upper(F.trim("vehicle_make")),
                                         "category": F.upper(F.trim("category"))})
    parts = recall_parts_availability(listings).withColumnsRenamed({k: f"p_{k}" for k in keys})
    summary = recall_summary(recalls)
    match = _same_vehicle(summary, parts, [(k, f"p_{k}") for k in keys], normalize_keys)

    severity, nb_parts = F.col("severity"), F.col("nb_parts_in_catalog")

    def potential(share: float, price: float) -> Column:
        return rnd(
            F.col("total_vehicles_affected") * F.lit(share) * F.coalesce("avg_part_price", F.lit(price)), 0
        )

    estimate = None
    for name, (share, price) in MARKET_POTENTIAL.items():
        value = potential(share, price)
        estimate = F.when(severity == name, value) if estimate is None else estimate.when(severity == name, value)
    return (
        summary.join(parts, match, "left")
        .withColumn("nb_parts_in_catalog", _zero("nb_parts_available"))
        .select(
            *summary.columns,
            "nb_parts_in_catalog", "avg_part_price",
            _zero("nb_brands_available").alias("nb_brands_covering"),
            (severity.isin("critique", "majeur") & (nb_parts == 0)).alias("is_critical_gap"),
            estimate.otherwise(potential(*MARKET_POTENTIAL_OTHER)).alias("estimated_market_potential_eur"),
        )
    )
