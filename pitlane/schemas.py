"""Bronze, silver and gold contracts.

Readers always apply the bronze schema, so no file is scanned to infer one and
types never drift between days. Silver functions select exactly the contract
plus the derived columns; whatever else a feed carries stops there.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


COMPATIBILITY = T.ArrayType(_struct(make=_S, model=_S, year_from=_I, year_to=_I))

#: Of a document as it arrived: the names of the fields it sent, and the text of a line that is no document.
PRESENT, CORRUPT = "_present", "_corrupt_record"
#: Where a reader tells them: the file a document came from, and the text of values that did not convert, by field.
FILE, UNREAD = "_file", "_unread"
#: Of a document whose feed already brought all documents of its key to one task: what that feed was shuffled by. It hangs
#: on the key alone; the deduplication takes it out.
PLACE = "_place"

BRONZE_PARTS = _struct(
    part_id=_S, part_number=_S, part_number_source=_S, brand=_S, brand_type=_S,
    category=_S, sub_category=_S, description=_S, price_eur=_D, currency=_S,
    stock_quantity=_I, availability=_S, vehicle_compatibility=COMPATIBILITY,
    supplier=_S, source=_S, quality_score=_D, ingested_at=_S, last_updated=_S,
    _fingerprint=_S,
)

BRONZE_LISTINGS = _struct(
    listing_id=_S, part_number=_S, brand=_S, category=_S, vehicle_make=_S,
    vehicle_model=_S, vehicle_year=_I, asking_price_eur=_D, negotiated_price_eur=_D,
    seller_type=_S, seller_region=_S, condition=_S, days_to_sell=_I,
    listing_date=_S, source=_S, ingested_at=_S,
)

BRONZE_RECALLS = _struct(
    recall_id=_S, manufacturer=_S, make=_S, model=_S, model_year=_I, component=_S,
    summary=_S, consequence=_S, remedy=_S, report_received_date=_S,
    record_creation_date=_S, potentially_affected=_I, source=_S, ingested_at=_S, _raw=_S,
)

BRONZE = {
    "parts_catalog": BRONZE_PARTS,
    "market_listings": BRONZE_LISTINGS,
    "vehicle_recalls": BRONZE_RECALLS,
}

ID_FIELDS = {
    "parts_catalog": "part_id",
    "market_listings": "listing_id",
    "vehicle_recalls": "recall_id",
}

SILVER_PARTS = [
    "part_id", "part_number", "brand", "brand_type", "category", "sub_category",
    "description", "price_eur", "stock_quantity", "availability", "supplier",
    "source", "quality_score", "_fingerprint", "ingested_at",
]

SILVER_LISTINGS = [
    "listing_id", "part_number", "brand", "category", "vehicle_make", "vehicle_model",
    "vehicle_year", "asking_price_eur", "negotiated_price_eur", "seller_type",
    "seller_region", "condition", "days_to_sell", "source", "ingested_at",
]

SILVER_RECALLS = [
    "recall_id", "manufacturer", "make", "model", "model_year", "component",
    "summary", "remedy", "potentially_affected", "source", "ingested_at",
]

SILVER_PARTITIONS = ["ingested_year", "ingested_month"]

FEED_STATS = _struct(inserted=_L, updated=_L, errors=_L, total=_L)

RUN_LOG = T.StructType([
    T.StructField("run_id", _S),
    T.StructField("dag_id", _S),
    T.StructField("status", _S),
    T.StructField("results", T.MapType(_S, FEED_STATS)),
    T.StructField("total_docs", _L),
    T.StructField("recorded_at", T.TimestampType()),
])

# Reading order of the marts; a stored table itself has no order. The trailing
# keys only make the order total.
MART_ORDER = {
    "mart_market_pricing": (["nb_catalog_references"], ["category", "brand", "brand_type"]),
    "mart_catalog_coverage": (["total_parts"], ["vehicle_make", "vehicle_model"]),
    "mart_supplier_performance": (["supplier_score"], ["supplier", "brand_type"]),
    "mart_recall_impact": (
        ["estimated_market_potential_eur"], ["vehicle_make", "component_category", "severity"],
    ),
}
