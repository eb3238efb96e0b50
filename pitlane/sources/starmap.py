"""Raw collections mapped from the supplied star-schema tables.

The expressions plant the defects the cleaning steps exist for: padded and
mixed-case text, prices and scores out of bounds, negative stock, missing
values, colliding ids, several sources per part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.schemas import PLACE

# Category names and an invented sub-category of each; the first two are also classes of recalls.
CATEGORIES = [
    ("Freinage", "Disque avant"),
    ("Moteur", "Joint à huile"),
    ("Suspension", "Ressort"),
    ("Électricité", "Faisceau"),
    ("Refroidissement", "Ventilateur"),
    ("Pneus", "Hiver 195/65R15"),
    ("Transmission", "Cardan"),
]

_ISO = "yyyy-MM-dd'T'HH:mm:ss"
# Not by p_partkey, which would be shuffled beside it.
_KEY = "cast(l_partkey AS string)"
_NUMBER = f"concat(p_brand, '-', lpad({_KEY}, greatest(6, length({_KEY})), '0'))"


def _pick(index: str, values: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {cases} END"


def _category(sub: bool = False) -> str:
    return _pick("l_partkey % 7", [c[int(sub)] for c in CATEGORIES])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem")


def _ordered(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items with their orders, shuffled by pairs of orders, as these share ids of documents.

    Only the first equality is a join key, so documents of one id meet in one task. ``_place`` tells the pair, by which
    the deduplication finds them where they are.
    """
    joined = lines.join(orders, F.expr("l_orderkey div 2 = o_orderkey div 2 AND l_orderkey - o_orderkey = 0"))
    return joined.withColumn(PLACE, F.expr("l_orderkey div 2"))


def _place(placed: bool) -> list[str]:
    return [PLACE] if placed else []


def _orders_of_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer and nation; joined before the line items, so that these are not shuffled by customer."""
    return (
        _table(spark, sf_dir, "orders")
        .join(_table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(_table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    )


def raw_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line item is one supplier's quote of a part."""
    vehicle = (
        "named_struct('make', concat('Make ', cast(l_suppkey % 25 AS string)), "
        "'model', concat('Model ', cast(l_partkey % 9 + i AS string)), "
        "'year_from', cast(1995 + l_partkey % 10 AS int), 'year_to', cast(2006 + l_suppkey % 15 AS int))"
    )
    # Parts last: if they are too many to broadcast, quotes of one part are left in one task, as the deduplication wants them.
    joined = (
        _lineitem(spark, sf_dir)
        .join(_table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(_table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    )
    return joined.selectExpr(
        "concat('P-', l_orderkey, '-', l_partkey, '-', l_suppkey, '-', l_linenumber) AS part_id",
        f"""CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN ''
                 WHEN l_linenumber = 4 AND l_quantity = 49 THEN '   '
                 WHEN l_linenumber = 6 THEN concat(' ', {_NUMBER})
                 WHEN l_linenumber = 5 THEN lower({_NUMBER})
                 ELSE {_NUMBER} END AS part_number""",
        f"CASE WHEN l_linenumber = 3 THEN translate({_NUMBER}, '-', ' ') ELSE {_NUMBER} END AS part_number_source",
        "CASE l_linenumber WHEN 1 THEN upper(p_brand) WHEN 2 THEN concat(p_brand, ' ') ELSE p_brand END AS brand",
        "CASE WHEN p_size % 2 = 0 THEN 'OEM' ELSE 'COMPAT' END AS brand_type",
        f"{_category()} AS category",
        f"{_category(sub=True)} AS sub_category",
        f"concat(p_brand, ' ', {_category(sub=True)}, ' pour Make ', cast(l_suppkey % 25 AS string)) AS description",
        "CASE WHEN l_quantity <> 13 THEN l_extendedprice / l_quantity - 100 END AS price_eur",
        "'EUR' AS currency",
        "cast(l_quantity AS int) - 5 AS stock_quantity",
        "CASE l_returnflag WHEN 'A' THEN ' IN_STOCK' WHEN 'R' THEN 'on_order ' ELSE 'Discontinued' END AS availability",
        f"transform(sequence(0, l_linenumber % 3), i -> {vehicle}) AS vehicle_compatibility",
        "s_name AS supplier",
        _pick("l_linenumber % 4", ["feed_direct", " Weekly_FILE", "web_offer ", "ORDER_BUS"]) + " AS source",
        "CASE WHEN l_quantity <> 17 THEN 1.05D - l_discount * 8 - l_tax END AS quality_score",
        f'date_format(l_shipdate, "{_ISO}") AS ingested_at',
        f'date_format(l_shipdate, "{_ISO}") AS last_updated',
        f"md5(concat(p_brand, ':', {_KEY})) AS _fingerprint",
    )


def raw_listings(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """One line item is one marketplace listing; two orders share their listing ids, as ``placed`` tells.

    One brand goes by another name here, so that the market and the catalogue
    each have a brand the other lacks.
    """
    joined = _ordered(
        _lineitem(spark, sf_dir).join(_table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey")),
        _orders_of_nations(spark, sf_dir).join(_table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")),
    ).withColumns({
        "asking": F.expr(
            "CASE WHEN l_linenumber = 7 AND l_quantity < 5 THEN -l_extendedprice / 100 ELSE l_extendedprice / 100 END"
        ),
        "days": F.expr("datediff(l_shipdate, o_orderdate)"),
        "brand_no": F.expr("cast(substring(p_brand, 7) AS int)"),
        "sold_as": F.expr("CASE p_brand WHEN 'Brand#7' THEN 'Marque#7' ELSE p_brand END"),
    })
    return joined.selectExpr(
        "concat(l_orderkey div 2, '-', l_linenumber) AS listing_id",
        f"{_NUMBER} AS part_number",
        "CASE l_linenumber WHEN 1 THEN upper(sold_as) WHEN 2 THEN concat(sold_as, ' ') ELSE sold_as END AS brand",
        f"concat({_category()}, CASE WHEN l_linenumber = 3 THEN ' ' ELSE '' END) AS category",
        "CASE l_linenumber % 3 WHEN 0 THEN lower(n_name) WHEN 1 THEN concat(n_name, ' ') ELSE n_name END AS vehicle_make",
        "concat(p_name, ' ', cast(c_custkey % 9 AS string)) AS vehicle_model",
        "year(o_orderdate) AS vehicle_year",
        "asking AS asking_price_eur",
        "asking * (1 - l_discount) AS negotiated_price_eur",
        "concat(' ', c_mktsegment) AS seller_type",
        "r_name AS seller_region",
        "CASE l_returnflag WHEN 'A' THEN 'New' WHEN 'R' THEN 'reconditioned ' ELSE 'used' END AS condition",
        """CASE WHEN days NOT BETWEEN 0 AND 60 THEN NULL
                WHEN brand_no <= 2 THEN days % 10
                WHEN brand_no <= 4 THEN days % 30
                ELSE days END AS days_to_sell""",
        f'date_format(o_orderdate, "{_ISO}") AS listing_date',
        "'marketplace' AS source",
        f'date_format(l_shipdate, "{_ISO}") AS ingested_at',
        *_place(placed),
    )


def raw_recalls(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """One line item is one version of the recall of its pair of orders, as ``placed`` tells."""
    joined = _ordered(
        _lineitem(spark, sf_dir).join(_table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey")),
        _orders_of_nations(spark, sf_dir),
    )
    return joined.selectExpr(
        "concat('R', l_orderkey div 2) AS recall_id",
        "concat(' ', n_name, ' Motors') AS manufacturer",
        "lower(n_name) AS make",
        "concat(p_name, ' ', cast(c_custkey % 9 AS string)) AS model",
        "cast(year(o_orderdate) - CASE WHEN l_linenumber = 7 THEN 30 ELSE 0 END AS int) AS model_year",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'SERVICE BRAKES, HYDRAULIC' WHEN '2-HIGH' THEN 'Engine cooling '
                WHEN '3-MEDIUM' THEN 'STEERING:COLUMN' WHEN '4-NOT SPECIFIED' THEN 'Airbag / fuel'
                ELSE 'Carburant' END AS component""",
        "concat('Recall of order ', cast(l_orderkey AS string)) AS summary",
        "concat('Part ', cast(l_partkey AS string), ' may fail') AS consequence",
        "'Replace' AS remedy",
        'date_format(o_orderdate, "dd/MM/yyyy") AS report_received_date',
        'date_format(l_shipdate, "dd/MM/yyyy") AS record_creation_date',
        """CASE WHEN l_quantity <> 13
                THEN cast(floor(o_totalprice / power(10, l_linenumber % 4)) AS int) END AS potentially_affected""",
        "'nhtsa_api' AS source",
        f'date_format(l_shipdate, "{_ISO}") AS ingested_at',
        "concat('{\"order\":', cast(l_orderkey AS string), '}') AS _raw",
        *_place(placed),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents keyed by user, with a free-form object kept as JSON text."""
    return _table(spark, sf_dir, "events").selectExpr(
        "cast(user_id AS string) AS user_id", "event_id", "event_type", "value", "props",
        "cast(ts AS timestamp) AS ingested_at",
    )


RAW = {"parts_catalog": raw_parts, "market_listings": raw_listings, "vehicle_recalls": raw_recalls}


def placed(spark: SparkSession, sf_dir: str, collection: str) -> DataFrame:
    """A raw collection for the deduplication, with ``_place`` where its documents are shuffled by what their ids hang on."""
    if collection == "parts_catalog":
        return raw_parts(spark, sf_dir)
    return RAW[collection](spark, sf_dir, placed=True)
