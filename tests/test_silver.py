from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import rows
from pitlane import schemas as S
from pitlane.operators import silver, silver_local
from rows import by


def test_parts_are_filtered_and_normalised(spark):
    out = by(silver.silver_parts(rows.parts(
        spark,
        {"part_id": None, "_fingerprint": "x1"},
        {"part_number": None, "_fingerprint": "x2"},
        {"part_number": "", "_fingerprint": "x3"},
        {"part_id": "blank", "part_number": "  ", "_fingerprint": "x4"},
        {"part_id": "a", "part_number": " ab-1 ", "brand": " mercedes-benz", "category": " Moteur ",
         "source": " EDI_Feed", "availability": " IN_STOCK ", "stock_quantity": -4, "_fingerprint": "x5"},
    )), "part_id")
    assert set(out) == {"blank", "a"}
    assert out["blank"]["part_number"] == ""
    a = out["a"]
    assert (a["part_number"], a["brand"], a["category"]) == ("AB-1", "Mercedes-benz", "Moteur")
    assert (a["source"], a["availability"], a["stock_quantity"]) == ("edi_feed", "in_stock", 0)
    assert (a["ingested_year"], a["ingested_month"]) == (2024, 3)


@pytest.mark.parametrize("price, kept, kept_local", [
    (-1.0, None, None), (0.0, None, None), (0.01, 0.01, 0.01), (9999.99, 9999.99, 9999.99),
    (10000.0, None, 10000.0), (10000.01, None, None), (None, None, None),
])
def test_price_bounds(spark, price, kept, kept_local):
    df = rows.parts(spark, {"price_eur": price})
    assert silver.silver_parts(df).first()["price_eur"] == kept
    assert silver_local.silver_parts_local(df).first()["price_eur"] == kept_local


def test_quality_is_clamped_and_unknown_is_one(spark):
    df = rows.parts(spark, *[{"part_id": str(i), "_fingerprint": str(i), "quality_score": q}
                             for i, q in enumerate([1.5, -0.2, 0.3, None])])
    assert [by(silver.silver_parts(df), "part_id")[str(i)]["quality_score"] for i in range(4)] == [1.0, 0.0, 0.3, 1.0]
    assert by(silver.silver_parts(df, null_quality="keep"), "part_id")["3"]["quality_score"] is None


def test_latest_quote_wins_and_unparsable_dates_come_last(spark):
    out = silver.silver_parts(rows.parts(
        spark,
        {"part_id": "old", "ingested_at": "2024-03-01T10:00:00"},
        {"part_id": "new", "ingested_at": "2024-03-02T10:00:00"},
        {"part_id": "bad", "ingested_at": "whenever"},
        {"part_id": "n1", "_fingerprint": None, "ingested_at": "whenever"},
        {"part_id": "n2", "_fingerprint": None, "ingested_at": "2020-01-01T00:00:00"},
    ))
    assert {r["part_id"] for r in out.collect()} == {"new", "n2"}


def test_undated_rows_stay_with_null_month(spark):
    row = silver.silver_parts(rows.parts(spark, {"ingested_at": "2024-13-45"})).first()
    assert row["ingested_year"] is None and row["ingested_month"] is None


def test_contract_columns_only(spark):
    extra = rows.parts(spark, {}).withColumn("surprise", F.lit(1))
    assert silver.silver_parts(extra).columns == [*S.SILVER_PARTS, *S.SILVER_PARTITIONS]


def test_ties_do_not_depend_on_distribution(spark):
    ties = [{"part_id": f"t{i:03d}", "price_eur": float(i + 1), "_fingerprint": f"f{i % 7}"} for i in range(300)]
    survivors = set()
    for parts, ordering in ((1, F.col("part_id")), (7, F.col("price_eur").desc()), (16, F.xxhash64("part_id"))):
        df = rows.parts(spark, *ties).orderBy(ordering).repartition(parts)
        survivors.add(tuple(sorted(r["part_id"] for r in silver.silver_parts(df).collect())))
    assert survivors == {tuple(f"t{i:03d}" for i in range(7))}


def test_hot_fingerprint_is_reduced_before_the_shuffle(spark):
    """A third of the rows share one key, another third have none."""
    df = spark.range(30000).selectExpr(
        "cast(id AS string) AS part_id",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE cast(id AS string) END AS _fingerprint",
        "date_format(timestamp_seconds(1.7e9 + id), \"yyyy-MM-dd'T'HH:mm:ss\") AS ingested_at",
    )
    base = rows.parts(spark, {}).drop("part_id", "_fingerprint", "ingested_at")
    wide = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in base.schema}).withColumn("part_number", F.lit("x"))
    out = silver.silver_parts(wide)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")
    assert out.count() == 10002
    assert out.where("_fingerprint = 'hot'").first()["part_id"] == "29997"


def test_recalls(spark):
    out = by(silver.silver_recalls(rows.recalls(
        spark,
        {"recall_id": None},
        {"recall_id": "a", "make": " renault ", "model": "grand scenic ", "component": " Brakes ", "model_year": 1979},
        {"recall_id": "b", "model_year": 1980}, {"recall_id": "c", "model_year": 2025},
        {"recall_id": "d", "model_year": 2026},
        {"recall_id": "d", "model_year": 2020, "ingested_at": "2024-03-02T00:00:00"},
    )), "recall_id")
    assert (out["a"]["make"], out["a"]["model"], out["a"]["component"]) == ("RENAULT", "Grand Scenic", "Brakes")
    assert [out[k]["model_year"] for k in "abcd"] == [None, 1980, 2025, 2020]
    assert "_raw" not in out["a"].asDict()


def test_listings_are_deduplicated_before_the_price_filter(spark):
    out = silver.silver_listings(rows.listings(
        spark,
        {"listing_id": "gone", "asking_price_eur": 10.0},
        {"listing_id": "gone", "asking_price_eur": -1.0, "ingested_at": "2024-03-02T00:00:00"},
        {"listing_id": "free", "asking_price_eur": 0.0}, {"listing_id": "unknown", "asking_price_eur": None},
        {"listing_id": "kept", "asking_price_eur": 80.0, "negotiated_price_eur": 70.0},
        {"listing_id": "open", "negotiated_price_eur": None},
    ))
    assert {r["listing_id"]: r["discount_rate"] for r in out.collect()} == {"kept": 0.125, "open": None}


def test_local_parts(spark):
    out = by(silver_local.silver_parts_local(rows.parts(
        spark,
        {"part_id": "blank", "part_number": "\t ", "_fingerprint": "b"},
        {"part_id": "a", "part_number": "\tab-1\n", "brand": " mercedes-benz", "category": " Moteur ",
         "availability": "On_Order ", "stock_quantity": -4, "quality_score": 1.4, "_fingerprint": "a"},
        {"part_id": "n", "availability": None, "_fingerprint": "n"},
    )), "part_id")
    assert set(out) == {"a", "n"}
    a = out["a"]
    assert (a["part_number"], a["brand"], a["category"]) == ("AB-1", "Mercedes-Benz", " Moteur ")
    assert (a["stock_quantity"], a["quality_score"], a["is_available"]) == (-4, 1.4, False)
    assert out["n"]["is_available"] is False


def test_local_prices_of_any_type(spark):
    df = rows.parts(spark, {"part_id": "a", "_fingerprint": "a"}, {"part_id": "b", "_fingerprint": "b"})
    df = df.withColumn("price_eur", F.expr("CASE part_id WHEN 'a' THEN '12.5' ELSE 'on request' END"))
    out = by(silver_local.silver_parts_local(df), "part_id")
    assert (out["a"]["price_eur"], out["b"]["price_eur"]) == (12.5, None)


def test_local_fast_sales(spark):
    df = rows.listings(spark, *[{"listing_id": str(d), "days_to_sell": d} for d in (0, 7, 8, None)])
    out = by(silver_local.silver_listings_local(df), "listing_id")
    assert [out[k]["is_fast_sale"] for k in ("0", "7", "8", "None")] == [True, True, False, False]


def test_cleaning_twice_changes_nothing(lake):
    once = lake.silver("parts_catalog")
    twice = silver.silver_parts(once)
    assert twice.exceptAll(once).isEmpty() and once.exceptAll(twice).isEmpty()
