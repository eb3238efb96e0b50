from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import rows
from pitlane.operators import enrich, marts, marts_local, quality, serving, silver, silver_local, staging
from pitlane.sources import shared
from rows import by


def catalog(spark, *specs: dict):
    specs = [{"part_id": f"p{i}", "_fingerprint": f"f{i}", **s} for i, s in enumerate(specs)]
    return staging.stg_parts(silver.silver_parts(rows.parts(spark, *specs)))


def offers(spark, *specs: dict):
    return staging.stg_listings(silver.silver_listings(rows.listings(
        spark, *[{"listing_id": f"l{i}", **s} for i, s in enumerate(specs)])))


def campaigns(spark, *specs: dict):
    return staging.stg_recalls(silver.silver_recalls(rows.recalls(
        spark, *[{"recall_id": f"r{i}", **s} for i, s in enumerate(specs)])))


@pytest.mark.parametrize("price, tier", [
    (None, "missing_price"), (4.99, "very_low"), (5.0, "low"), (49.99, "low"), (50.0, "medium"), (200.0, "high"),
    (500.0, "premium"),
])
def test_price_tiers(spark, price, tier):
    assert catalog(spark, {"price_eur": price}).first()["price_tier"] == tier


def test_availability_is_three_valued(spark):
    out = by(catalog(spark, *[{"availability": a} for a in ("in_stock", "discontinued", "on_order", None)]), "part_id")
    assert [out[f"p{i}"]["is_available"] for i in range(4)] == [True, False, None, None]


def test_blank_part_numbers_end_at_staging(spark):
    assert catalog(spark, {"part_number": "   "}).isEmpty()


@pytest.mark.parametrize("component, category", [
    ("SERVICE BRAKES, HYDRAULIC", "Freinage"), ("Frein à main", "Freinage"), ("Engine brake", "Freinage"),
    ("MOTEUR", "Moteur"), ("Steering:column", "Direction"), ("restraint / fuel", "Sécurité passive"),
    ("Carburant", "Alimentation"), ("Seats", "Autre"), (None, "Autre"),
])
def test_component_classes(spark, component, category):
    assert campaigns(spark, {"component": component}).first()["component_category"] == category


def test_severity(spark):
    affected = [100000, 99999, 10000, 1000, 999, None]
    out = by(campaigns(spark, *[{"potentially_affected": a} for a in affected]), "recall_id")
    assert [out[f"r{i}"]["severity"] for i in range(6)] == ["critique", "majeur", "majeur", "modéré", "mineur", "mineur"]


def test_price_segments(spark):
    out = by(offers(spark, *[{"asking_price_eur": p} for p in (29.0, 30.0, 100.0, 300.0, 10000.0)]), "listing_id")
    assert [out[f"l{i}"]["price_segment"] for i in range(4)] == [
        "entrée de gamme", "milieu de gamme", "premium", "haut de gamme"]
    assert "l4" not in out


def test_outliers(spark):
    prices = [10.0, 11.0, 12.0, 13.0, 14.0, 22.0, 22.5, 24.6]
    df = catalog(spark, *[{"price_eur": p} for p in prices], {"price_eur": None}, {"price_eur": 9999.0, "category": "Pneus"},
                 {"price_eur": 9999.0, "category": None})
    out = by(enrich.int_parts_enriched(df, threshold=1.0), "part_id")
    q1, q3 = out["p0"]["category_q1"], out["p0"]["category_q3"]
    assert [out[f"p{i}"]["is_price_outlier"] for i in range(8)] == [p > q3 + (q3 - q1) for p in prices]
    assert [out[f"p{i}"]["is_price_outlier"] for i in (8, 9, 10)] == [False, False, False]
    assert out["p10"]["category_median_price"] is None and out["p9"]["price_vs_median_ratio"] == 1.0


@pytest.mark.parametrize("sources, quality_score, spread, expected", [
    (1, 0.8, None, 1 / 3 * 0.4 + 0.28 + 0.25), (2, 0.8, 0.049, 2 / 3 * 0.4 + 0.28 + 0.25),
    (3, 1.0, 0.05, 0.4 + 0.35 + 0.15), (9, 0.0, 0.15, 0.4 + 0.05), (3, None, 0.0, None),
])
def test_reliability(spark, sources, quality_score, spread, expected):
    df = spark.createDataFrame([(sources, quality_score, spread)], "n int, q double, s double")
    got = df.select(enrich.int_reliability_score(F.col("n"), F.col("q"), F.col("s"))).first()[0]
    assert got == (None if expected is None else pytest.approx(expected))


def test_sources_are_counted_before_the_dedup_if_asked(spark):
    quotes = rows.parts(
        spark,
        {"part_id": "a", "source": "edi_feed", "supplier": "x", "price_eur": 10.0, "ingested_at": "2024-03-02T00:00:00"},
        {"part_id": "b", "source": "catalog_csv", "supplier": "y", "price_eur": 11.0},
        {"part_id": "c", "source": " EDI_feed", "supplier": "z", "price_eur": None},
        {"part_id": "d", "_fingerprint": None},
    )
    cleaned = silver.clean_parts(quotes)
    deduped = staging.stg_parts(silver.dedup_parts(cleaned))
    literal = by(enrich.int_parts_enriched(deduped), "part_id")
    multi = by(enrich.int_parts_enriched(deduped, staging.stg_parts(cleaned)), "part_id")
    assert (literal["a"]["nb_sources"], literal["a"]["price_spread_ratio"]) == (1, 0.0)
    assert (multi["a"]["nb_sources"], multi["a"]["nb_suppliers"], multi["a"]["price_spread_ratio"]) == (2, 3, 0.1)
    assert (multi["d"]["nb_sources"], multi["d"]["price_spread_ratio"]) == (1, None)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_enrichment_keeps_every_row_of_a_hot_group(spark, threshold):
    df = shared.store(catalog(spark, *[{"price_eur": float(i % 50 + 1), "category": "Pneus"} for i in range(400)]), "c")
    stats = shared.store(enrich.int_price_stats(df), "stats")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = enrich.int_parts_enriched(df, price_stats=stats)
        assert "_salt" in out._jdf.queryExecution().optimizedPlan().toString()
        assert out.count() == 400 and out.where("category_median_price IS NULL").isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_fingerprint_is_split(spark, tmp_path):
    """Half the catalogue on one fingerprint: the join is one that adaptive execution splits."""
    path = str(tmp_path / "catalog")
    catalog(spark, {}).crossJoin(spark.range(60_000).withColumnRenamed("id", "n")).withColumns({
        "part_id": F.concat(F.lit("p"), F.col("n")),
        "_fingerprint": F.when(F.col("n") % 2 == 0, "hot").otherwise(F.concat(F.lit("f"), F.col("n"))),
        "description": F.sha2(F.col("n").cast("string"), 512),
    }).drop("n").write.parquet(path)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k", "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = enrich.int_parts_enriched(spark.read.parquet(path))
        assert len(out.collect()) == 60_000
        plan = out._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.split("Initial Plan")[0].splitlines() if "Join" in line and "_fingerprint" in line]
        assert joins and any("skew=true" in line for line in joins), plan[:3000]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_pricing_keeps_both_unmatched_sides(spark):
    enriched = enrich.int_parts_enriched(catalog(
        spark, {"price_eur": 100.0}, {"brand": "Valeo", "price_eur": 20.0}, {"brand": "Valeo", "price_eur": None},
        {"brand": None, "price_eur": 5.0}))
    market = offers(
        spark, {"asking_price_eur": 130.0, "days_to_sell": 7}, {"asking_price_eur": 110.0, "days_to_sell": 7},
        {"brand": "Sachs", "days_to_sell": None}, {"brand": None, "days_to_sell": 21})
    out = {(r["brand"], r["brand_type"]): r for r in marts.mart_market_pricing(enriched, market).collect()}
    assert set(out) == {("Bosch", "OEM"), ("Valeo", "OEM"), ("Sachs", None), (None, "OEM"), (None, None)}
    bosch = out["Bosch", "OEM"]
    assert (bosch["market_vs_catalog_pct"], bosch["market_liquidity"], bosch["nb_fast_sales"]) == (20.0, "haute", 2)
    assert (out["Valeo", "OEM"]["nb_catalog_references"], out["Valeo", "OEM"]["nb_market_listings"]) == (1, 0)
    assert (out["Sachs", None]["nb_catalog_references"], out["Sachs", None]["market_liquidity"]) == (0, "faible")
    assert out[None, None]["market_liquidity"] == "moyenne"


SUPPLIERS = {
    "strategic": [dict(quality_score=1.0, availability="in_stock")] * 5,
    "dependable": [dict(quality_score=0.9, availability="in_stock")] * 3 + [dict(quality_score=0.9, availability="on_order")],
    "watched": [dict(quality_score=0.9, availability="discontinued")] * 2,
    "risky": [dict(quality_score=0.0, availability="in_stock")] * 2,
}


def test_supplier_tiers(spark):
    specs = [{"supplier": s, "price_eur": 10.0, "part_number": f"n{i}", **fields}
             for s, group in SUPPLIERS.items() for i, fields in enumerate(group)]
    enriched = enrich.int_parts_enriched(catalog(spark, *specs, {"supplier": None})).withColumn(
        "reliability_score", F.col("quality_score") * 0.9 + F.when(F.col("supplier") == "risky", 0.1).otherwise(0.0))
    out = by(marts.mart_supplier_performance(enriched), "supplier")
    assert {s: r["supplier_tier"][:6] for s, r in out.items()} == {
        "strategic": "Tier 1", "dependable": "Tier 2", "watched": "Tier 3", "risky": "Tier 4"}
    assert out["strategic"]["supplier_score"] == pytest.approx((35 + 0.9 * 35 + 0 + 10) * 100)


def test_supplier_outlier_points(spark):
    specs = [{"supplier": "s", "price_eur": 10.0 + i % 5, "part_number": f"n{i}"} for i in range(60)]
    specs.append({"supplier": "s", "price_eur": 900.0, "part_number": "dear"})
    row = marts.mart_supplier_performance(enrich.int_parts_enriched(catalog(spark, *specs))).first()
    reliability = row["avg_reliability_score"]
    assert (row["nb_price_outliers"], row["nb_unique_refs"]) == (1, 61)
    assert row["supplier_score"] == pytest.approx((35 + reliability * 35 + 7) * 100, abs=0.1)


def test_local_supplier_tiers_ignore_availability_below_the_first(spark):
    specs = [{"part_id": f"{s}{i}", "_fingerprint": f"{s}{i}", "supplier": s, **fields}
             for s, group in SUPPLIERS.items() for i, fields in enumerate(group)]
    out = by(marts_local.mart_supplier_performance_local(
        silver_local.silver_parts_local(rows.parts(spark, *specs))), "supplier")
    assert {s: r["supplier_tier"][:6] for s, r in out.items()} == {
        "strategic": "Tier 1", "dependable": "Tier 2", "watched": "Tier 2", "risky": "Tier 4"}


def test_coverage_meets_recalls_only_with_normal_keys(spark):
    market = offers(spark, {}, {"vehicle_year": 2016}, {"category": "Pneus"}, {"vehicle_make": "Fiat"})
    recalled = campaigns(spark, {"make": "renault", "model": "CLIO"}, {"make": "Renault", "model": "clio", "potentially_affected": 200000})
    literal = by(marts.mart_catalog_coverage(market, recalled), "vehicle_make")
    normal = by(marts.mart_catalog_coverage(market, recalled, normalize_keys=True), "vehicle_make")
    assert literal["Renault"]["total_recalls"] == 0 and not literal["Renault"]["is_coverage_opportunity"]
    row = normal["Renault"]
    assert (row["total_recalls"], row["critical_recalls"], row["vehicles_affected_by_recalls"]) == (2, 1, 200500)
    assert (row["coverage_score_pct"], row["coverage_level"], row["is_coverage_opportunity"]) == (
        28.6, "couverture faible", True)
    assert (row["years_covered"], row["total_parts"], row["total_listings"]) == (2, 3, 3)
    assert normal["Fiat"]["total_recalls"] == 0


def test_number_of_categories_is_a_parameter(spark):
    out = marts.mart_catalog_coverage(offers(spark, {}), campaigns(spark, {}), n_categories=1).first()
    assert (out["coverage_score_pct"], out["coverage_level"]) == (100.0, "couverture complète")


def test_recall_impact(spark):
    market = offers(spark, {"vehicle_make": "Renault", "asking_price_eur": 50.0}, {"condition": "used", "brand": "Old"})
    recalled = campaigns(
        spark, {"potentially_affected": 100000}, {"component": "engine", "potentially_affected": 10000},
        {"component": "fuel", "potentially_affected": 10}, {"component": "fuel", "potentially_affected": None, "make": "x"})
    out = {(r["vehicle_make"], r["component_category"]): r
           for r in marts.mart_recall_impact(recalled, market, normalize_keys=True).collect()}
    brakes, engine, fuel = (out["RENAULT", c] for c in ("Freinage", "Moteur", "Alimentation"))
    assert (brakes["nb_parts_in_catalog"], brakes["is_critical_gap"], brakes["nb_brands_covering"]) == (1, False, 1)
    assert brakes["estimated_market_potential_eur"] == 100000 * 0.8 * 50
    assert (engine["is_critical_gap"], engine["estimated_market_potential_eur"]) == (True, 10000 * 0.6 * 80)
    assert (fuel["is_critical_gap"], fuel["estimated_market_potential_eur"]) == (False, 10 * 0.3 * 50)
    assert out["X", "Alimentation"]["estimated_market_potential_eur"] is None
    assert {r["nb_parts_in_catalog"] for r in marts.mart_recall_impact(recalled, market).collect()} == {0}


def test_quality_checks(spark):
    df = rows.listings(spark, {"listing_id": "a"}, {"listing_id": "a"}, {"listing_id": "b", "condition": "broken"},
                       {"listing_id": None, "condition": None}, {"listing_id": None})
    assert [tuple(r) for r in quality.dq_unique(df, "listing_id").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.dq_accepted_values(df, "condition", ["new"]).collect()] == [("broken", 1)]
    report = quality.dq_not_null({"m": (df, ["listing_id", "condition", "brand"])})
    assert {r["column"]: r["failures"] for r in report.collect()} == {"listing_id": 2, "condition": 1, "brand": 0}


def test_enriched_invariants(spark):
    df = spark.createDataFrame([(-1.0, 0.5), (3.0, 1.2), (None, None), (2.0, -0.1)], "price_eur double, reliability_score double")
    assert quality.dq_no_negative_prices(df).first()[0] == 1
    assert quality.dq_reliability_bounded(df).first()[0] == 2


def test_a_null_make_counts_as_a_make(spark):
    pricing = spark.createDataFrame([(3, 0.5, 4), (2, None, 1)], "nb_catalog_references long, avg_quality_score double, nb_market_listings long")
    coverage = spark.createDataFrame([("A",), ("B",), (None,), (None,)], "vehicle_make string")
    row = serving.kpi_overview(pricing, coverage).first()
    assert tuple(row) == (5, 0.5, 5, 3)
    empty = serving.kpi_overview(pricing, coverage.where("false")).first()
    assert empty["vehicle_makes"] == 0


def test_report_order(spark):
    suppliers = spark.createDataFrame([(f"s{i}", "OEM", float(i), "Tier 1 — Stratégique", 0.7, 70.0, 1) for i in range(15)],
        "supplier string, brand_type string, supplier_score double, supplier_tier string, avg_quality_score double, "
        "availability_rate_pct double, nb_unique_refs long")
    assert [r["supplier"] for r in serving.supplier_top10(suppliers).collect()] == [f"s{i}" for i in range(5, 15)]
    assert [tuple(r) for r in serving.supplier_quadrants(suppliers).collect()] == [("reliable/available", 15, 15)]


def test_approximate_distinct_counts(spark):
    market = offers(spark, *[{"part_number": f"n{i}"} for i in range(200)])
    exact, close = (marts.coverage_by_vehicle(market, rsd).first()["nb_distinct_parts"] for rsd in (None, 0.02))
    assert exact == 200 and abs(close - 200) <= 20
