"""Hand-made documents."""

from __future__ import annotations

from pitlane import schemas as S


def part(**fields) -> dict:
    return {
        "part_id": "p1", "part_number": "BOS-FR-000001", "part_number_source": "BOS-FR-000001", "brand": "Bosch",
        "brand_type": "OEM", "category": "Freinage", "sub_category": "Disques", "description": "d",
        "price_eur": 50.0, "currency": "EUR", "stock_quantity": 3, "availability": "in_stock",
        "vehicle_compatibility": [], "supplier": "Acme", "source": "edi_feed", "quality_score": 0.8,
        "ingested_at": "2024-03-01T10:00:00", "last_updated": "2024-03-01T10:00:00", "_fingerprint": "f1", **fields,
    }


def listing(**fields) -> dict:
    return {
        "listing_id": "l1", "part_number": "BOS-FR-000001", "brand": "Bosch", "category": "Freinage",
        "vehicle_make": "Renault", "vehicle_model": "Clio", "vehicle_year": 2015, "asking_price_eur": 100.0,
        "negotiated_price_eur": 90.0, "seller_type": "garage", "seller_region": "PACA", "condition": "new",
        "days_to_sell": 5, "listing_date": "2024-03-01T10:00:00", "source": "marketplace",
        "ingested_at": "2024-03-01T10:00:00", **fields,
    }


def recall(**fields) -> dict:
    return {
        "recall_id": "r1", "manufacturer": "Renault SA", "make": "RENAULT", "model": "Clio", "model_year": 2015,
        "component": "BRAKES", "summary": "s", "consequence": "c", "remedy": "r", "report_received_date": "01/01/2024",
        "record_creation_date": "01/01/2024", "potentially_affected": 500, "source": "nhtsa_api",
        "ingested_at": "2024-03-01T10:00:00", "_raw": "{}", **fields,
    }


def parts(spark, *rows: dict):
    return spark.createDataFrame([part(**r) for r in rows], S.BRONZE_PARTS)


def listings(spark, *rows: dict):
    return spark.createDataFrame([listing(**r) for r in rows], S.BRONZE_LISTINGS)


def recalls(spark, *rows: dict):
    return spark.createDataFrame([recall(**r) for r in rows], S.BRONZE_RECALLS)


def by(df, key: str) -> dict:
    return {row[key]: row for row in df.collect()}
