"""DuckDB SQL that states, independently of Spark, what each query returns.

``STEPS`` are named sub-selects over the base tables; a query's SQL is a WITH
chain of the steps it mentions, directly or through others.
"""

from __future__ import annotations

import re

from pitlane.plans.registry import (
    EARLIER_RUN_DATE, EVENTS_FROM, EVENTS_TO, FEED_MAKES, FEED_YEARS, FIRST_LOAD, RUN_DATE, RUN_TS, SECOND_LOAD, SPLIT,
)


def _rnd(x: str, n: int) -> str:
    return f"cast(round(cast({x} as decimal(38,10)), {n}) as double)"


def _initcap(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({x}, ' '), "
        "lambda w: concat(upper(left(w, 1)), lower(substr(w, 2)))), ' ')"
    )


def _title(x: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all({x}, '(\p{{L}}+|[^\p{{L}}]+)'), "
        "lambda w: concat(upper(left(w, 1)), lower(substr(w, 2)))), '')"
    )


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _pct(part: str, whole: str = "count(*)") -> str:
    return _rnd(f"{part} * 100.0 / nullif({whole}, 0)", 1)


def _zero(x: str, alias: str) -> str:
    return f"ifnull({x}, 0) as {alias}"


def _count(condition: str) -> str:
    return f"count(*) filter (where {condition})"


_KEY = "lpad(p_partkey::varchar, greatest(6, length(p_partkey::varchar))::integer, '0')"
_NUMBER = f"p_brand || '-' || {_KEY}"
_CATEGORY = """case l_partkey % 7 when 0 then 'Freinage' when 1 then 'Moteur' when 2 then 'Suspension'
    when 3 then 'Électricité' when 4 then 'Refroidissement' when 5 then 'Pneus' when 6 then 'Transmission' end"""
_SUB = """case l_partkey % 7 when 0 then 'Disque avant' when 1 then 'Joint à huile' when 2 then 'Ressort'
    when 3 then 'Faisceau' when 4 then 'Ventilateur' when 5 then 'Hiver 195/65R15' when 6 then 'Cardan' end"""
_SHIP = "strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')"
_ORDERED = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')"
_BRAND = "case l_linenumber when 1 then upper({0}) when 2 then {0} || ' ' else {0} end"
_SOLD_AS = "if(p_brand = 'Brand#7', 'Marque#7', p_brand)"
_DATED = "try_cast(ingested_at as timestamp) as ts"
_MONTH = "cast(year(ts) as integer) as ingested_year, cast(month(ts) as integer) as ingested_month"


def _content(*columns: str) -> str:
    return ", ".join(f"{c} asc nulls first" for c in columns)


def _newest_content(*columns: str) -> str:
    return ", ".join(f"{c} desc nulls last" for c in columns)


_LISTING_TIES = _content(
    "part_number", "brand", "category", "vehicle_make", "vehicle_model", "vehicle_year", "asking_price_eur",
    "negotiated_price_eur", "seller_type", "seller_region", "condition", "days_to_sell", "source",
)
_RECALL_TIES = _content(
    "manufacturer", "make", "model", "model_year", "component", "summary", "remedy", "potentially_affected", "source",
)

STEPS: dict[str, str] = {}

# --- raw collections --------------------------------------------------------

STEPS["raw_parts"] = f"""
select 'P-' || l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber as part_id,
    case when l_linenumber = 7 and l_quantity = 50 then ''
         when l_linenumber = 4 and l_quantity = 49 then '   '
         when l_linenumber = 6 then ' ' || {_NUMBER}
         when l_linenumber = 5 then lower({_NUMBER})
         else {_NUMBER} end as part_number,
    case when l_linenumber = 3 then replace({_NUMBER}, '-', ' ') else {_NUMBER} end as part_number_source,
    {_BRAND.format('p_brand')} as brand,
    case when p_size % 2 = 0 then 'OEM' else 'COMPAT' end as brand_type,
    {_CATEGORY} as category, {_SUB} as sub_category,
    p_brand || ' ' || {_SUB} || ' pour Make ' || (l_suppkey % 25) as description,
    case when l_quantity <> 13 then l_extendedprice / l_quantity - 100 end as price_eur,
    'EUR' as currency, cast(l_quantity as integer) - 5 as stock_quantity,
    case l_returnflag when 'A' then ' IN_STOCK' when 'R' then 'on_order ' else 'Discontinued' end as availability,
    to_json(list_transform(range(0, l_linenumber % 3 + 1), lambda i: {{
        'make': 'Make ' || (l_suppkey % 25), 'model': 'Model ' || (l_partkey % 9 + i),
        'year_from': cast(1995 + l_partkey % 10 as integer), 'year_to': cast(2006 + l_suppkey % 15 as integer)
    }}))::varchar as vehicle_compatibility,
    s_name as supplier,
    case l_linenumber % 4 when 0 then 'feed_direct' when 1 then ' Weekly_FILE'
        when 2 then 'web_offer ' else 'ORDER_BUS' end as source,
    case when l_quantity <> 17 then 1.05::double - l_discount * 8 - l_tax end as quality_score,
    {_SHIP} as ingested_at, {_SHIP} as last_updated, md5(p_brand || ':' || p_partkey) as _fingerprint
from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey"""

STEPS["raw_listings"] = f"""
select (l_orderkey // 2) || '-' || l_linenumber as listing_id, {_NUMBER} as part_number,
    {_BRAND.format(_SOLD_AS)} as brand,
    {_CATEGORY} || case when l_linenumber = 3 then ' ' else '' end as category,
    case l_linenumber % 3 when 0 then lower(n_name) when 1 then n_name || ' ' else n_name end as vehicle_make,
    p_name || ' ' || (c_custkey % 9) as vehicle_model, cast(year(o_orderdate) as integer) as vehicle_year,
    asking as asking_price_eur, asking * (1 - l_discount) as negotiated_price_eur,
    ' ' || c_mktsegment as seller_type, r_name as seller_region,
    case l_returnflag when 'A' then 'New' when 'R' then 'reconditioned ' else 'used' end as condition,
    cast(case when days not between 0 and 60 then null when brand_no <= 2 then days % 10
         when brand_no <= 4 then days % 30 else days end as integer) as days_to_sell,
    {_ORDERED} as listing_date, 'marketplace' as source, {_SHIP} as ingested_at
from (select *, l_extendedprice / 100 * case when l_linenumber = 7 and l_quantity < 5 then -1 else 1 end as asking,
        date_diff('day', o_orderdate, l_shipdate) as days, cast(substr(p_brand, 7) as integer) as brand_no
      from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey
      join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
      join region on n_regionkey = r_regionkey)"""

STEPS["raw_recalls"] = f"""
select 'R' || (l_orderkey // 2) as recall_id, ' ' || n_name || ' Motors' as manufacturer, lower(n_name) as make,
    p_name || ' ' || (c_custkey % 9) as model,
    cast(year(o_orderdate) - case when l_linenumber = 7 then 30 else 0 end as integer) as model_year,
    case o_orderpriority when '1-URGENT' then 'SERVICE BRAKES, HYDRAULIC' when '2-HIGH' then 'Engine cooling '
        when '3-MEDIUM' then 'STEERING:COLUMN' when '4-NOT SPECIFIED' then 'Airbag / fuel'
        else 'Carburant' end as component,
    'Recall of order ' || l_orderkey as summary, 'Part ' || l_partkey || ' may fail' as consequence,
    'Replace' as remedy, strftime(o_orderdate, '%d/%m/%Y') as report_received_date,
    strftime(l_shipdate, '%d/%m/%Y') as record_creation_date,
    case when l_quantity <> 13
        then cast(floor(o_totalprice / pow(10, l_linenumber % 4)) as integer) end as potentially_affected,
    'nhtsa_api' as source, {_SHIP} as ingested_at, '{{"order":' || l_orderkey || '}}' as _raw
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey"""

# --- silver -----------------------------------------------------------------

STEPS["clean_parts"] = f"""
select part_id, trim(upper(part_number)) as part_number, trim({_initcap('brand')}) as brand, brand_type,
    trim(category) as category, sub_category, description,
    case when price_eur > 0 and price_eur < 10000 then price_eur end as price_eur,
    case when stock_quantity >= 0 then stock_quantity else 0 end as stock_quantity,
    trim(lower(availability)) as availability, supplier, trim(lower(source)) as source,
    greatest(least(quality_score, 1.0), 0.0) as quality_score, _fingerprint, ingested_at, {_DATED}
from raw_parts where part_id is not null and part_number is not null and part_number <> ''"""

STEPS["s_parts"] = f"""
select * exclude (ts, rn), {_MONTH} from (
    select *, row_number() over (partition by _fingerprint order by ts desc nulls last, part_id) as rn
    from clean_parts) where rn = 1"""

STEPS["s_recalls"] = f"""
select recall_id, trim(manufacturer) as manufacturer, trim(upper(make)) as make,
    trim({_initcap('model')}) as model,
    case when model_year between 1980 and 2025 then model_year end as model_year,
    trim(component) as component, summary, remedy, potentially_affected, source, ingested_at, {_MONTH}
from (select *, row_number() over (partition by recall_id order by ts desc nulls last, {_RECALL_TIES}) as rn
      from (select *, {_DATED} from raw_recalls where recall_id is not null)) where rn = 1"""

STEPS["latest_listings"] = f"""
select * from (
    select *, row_number() over (partition by listing_id order by ts desc nulls last, {_LISTING_TIES}) as rn
    from (select *, {_DATED} from raw_listings where listing_id is not null)) where rn = 1"""

STEPS["s_listings"] = f"""
select listing_id, part_number, trim({_initcap('brand')}) as brand, trim(category) as category,
    trim({_initcap('vehicle_make')}) as vehicle_make, trim(vehicle_model) as vehicle_model, vehicle_year,
    asking_price_eur, negotiated_price_eur, trim(lower(seller_type)) as seller_type, seller_region,
    trim(lower(condition)) as condition, days_to_sell, source, ingested_at,
    {_rnd('1.0 - negotiated_price_eur / asking_price_eur', 4)} as discount_rate, {_MONTH}
from latest_listings where asking_price_eur > 0"""

STEPS["s_parts_local"] = f"""
select * exclude (ts, rn) from (
    select part_id, upper({_strip('part_number')}) as part_number, part_number_source,
        {_title(_strip('brand'))} as brand, brand_type, category, sub_category, description,
        case when price_eur > 0 and price_eur <= 10000 then price_eur end as price_eur, currency, stock_quantity,
        lower({_strip('availability')}) as availability, vehicle_compatibility, supplier,
        lower({_strip('source')}) as source, quality_score, strftime(ts, '%Y-%m-%d %H:%M:%S') as ingested_at,
        last_updated, _fingerprint, ts, lower({_strip('availability')}) = 'in_stock' as is_available, {_MONTH},
        row_number() over (partition by _fingerprint order by ts desc nulls last, part_id) as rn
    from (select *, {_DATED} from raw_parts
          where part_id is not null and {_strip('part_number')} <> '')) where rn = 1"""



def _listings_local(category: str) -> str:
    return f"""
select listing_id, part_number, {_title(_strip('brand'))} as brand, {category} as category,
    {_title(_strip('vehicle_make'))} as vehicle_make, vehicle_model, vehicle_year, asking_price_eur,
    negotiated_price_eur, lower({_strip('seller_type')}) as seller_type, seller_region,
    lower({_strip('condition')}) as condition, days_to_sell, listing_date, source,
    strftime(ts, '%Y-%m-%d %H:%M:%S') as ingested_at,
    cast(round_even(cast((asking_price_eur - negotiated_price_eur) / asking_price_eur as decimal(38,10)), 4)
        as double) as discount_rate,
    days_to_sell is not null and days_to_sell <= 7 as is_fast_sale, {_MONTH}
from latest_listings where asking_price_eur > 0"""


STEPS["s_listings_local"] = _listings_local(_strip("category"))
STEPS["s_listings_scheduled"] = _listings_local("category")

# --- staging ----------------------------------------------------------------


def _stg_parts(source: str, months: str) -> str:
    return f"""
select part_id, part_number, trim(brand) as brand, trim(brand_type) as brand_type, trim(category) as category,
    trim(sub_category) as sub_category, description, price_eur, stock_quantity::integer as stock_quantity,
    lower(trim(availability)) as availability, supplier, lower(trim(source)) as source, quality_score, _fingerprint,
    {months}, map {{'in_stock': true, 'discontinued': false}}[availability] as is_available,
    ifnull(['very_low', 'low', 'medium', 'high', 'premium'][1 + (price_eur >= 5)::int + (price_eur >= 50)::int
        + (price_eur >= 200)::int + (price_eur >= 500)::int], 'missing_price') as price_tier
from {source} where length(part_number) > 0"""


STEPS["st_parts"] = _stg_parts("s_parts", "ingested_year, ingested_month")
STEPS["st_quotes"] = _stg_parts("clean_parts", _MONTH)

STEPS["st_listings"] = """
select * exclude (ingested_at) replace (trim(brand) as brand, trim(category) as category,
        trim(vehicle_make) as vehicle_make,
        trim(vehicle_model) as vehicle_model, lower(trim(seller_type)) as seller_type,
        trim(seller_region) as seller_region, lower(trim(condition)) as condition),
    ifnull(days_to_sell <= 7, false) as is_fast_sale,
    ['entrée de gamme', 'milieu de gamme', 'premium', 'haut de gamme']
        [1 + (asking_price_eur >= 30)::int + (asking_price_eur >= 100)::int + (asking_price_eur >= 300)::int]
        as price_segment
from s_listings where asking_price_eur > 0 and asking_price_eur < 10000"""

STEPS["st_recalls"] = """
select recall_id, upper(trim(make)) as vehicle_make, trim(model) as vehicle_model, model_year,
    trim(manufacturer) as manufacturer, trim(component) as component, summary, remedy, potentially_affected, source,
    ingested_year, ingested_month,
    ifnull((select label from (values (1, 'brake|frein', 'Freinage'), (2, 'engine|moteur', 'Moteur'),
        (3, 'steering|direction', 'Direction'), (4, 'airbag|restraint', 'Sécurité passive'),
        (5, 'fuel|carburant', 'Alimentation')) as classes(rank, words, label)
        where regexp_matches(lower(component), words) order by rank limit 1), 'Autre') as component_category,
    ['mineur', 'modéré', 'majeur', 'critique'][1 + ifnull((potentially_affected >= 1000)::int
        + (potentially_affected >= 10000)::int + (potentially_affected >= 100000)::int, 0)] as severity
from s_recalls where length(recall_id) > 0"""

# --- enrichment -------------------------------------------------------------

STEPS["price_stats"] = """
select category, brand_type, quantile_cont(price_eur, 0.25) as q1, quantile_cont(price_eur, 0.5) as median_price,
    quantile_cont(price_eur, 0.75) as q3, avg(price_eur) as avg_price, stddev_samp(price_eur) as stddev_price,
    count(*) as parts_count
from st_parts where price_eur is not null group by all"""


def _coverage(source: str) -> str:
    return f"""
select _fingerprint, count(distinct source) as nb_sources, count(distinct supplier) as nb_suppliers,
    min(price_eur) as min_price, max(price_eur) as max_price, avg(price_eur) as avg_price_cross_source,
    case when min(price_eur) > 0
        then {_rnd('(max(price_eur) - min(price_eur)) / min(price_eur)', 4)} end as price_spread_ratio
from {source} where _fingerprint is not null group by _fingerprint"""


STEPS["source_coverage"] = _coverage("st_parts")
STEPS["quote_coverage"] = _coverage("st_quotes")


def _enriched(coverage: str) -> str:
    coherence = """case when price_spread_ratio >= 0.15 then 0.05::double when price_spread_ratio >= 0.05
        then 0.15::double else 0.25::double end"""
    sources = "ifnull(nb_sources, 1)"
    score = f"least({sources}::double / 3, 1) * 0.40::double + quality_score * 0.35::double + {coherence}"
    return f"""
select c.*, median_price as category_median_price, avg_price as category_avg_price, q1 as category_q1,
    q3 as category_q3, parts_count as category_parts_count,
    ifnull(price_eur not between q1 - 5 * (q3 - q1) and q3 + 5 * (q3 - q1), false) as is_price_outlier,
    if(median_price > 0, {_rnd('price_eur / median_price', 4)}, null) as price_vs_median_ratio,
    {sources} as nb_sources, ifnull(nb_suppliers, 1) as nb_suppliers, price_spread_ratio,
    {_rnd(score, 4)} as reliability_score
from st_parts c left join price_stats using (category, brand_type) left join {coverage} using (_fingerprint)"""


STEPS["enriched"] = _enriched("source_coverage")
STEPS["enriched_multi"] = _enriched("quote_coverage")

# --- market pricing ---------------------------------------------------------


def _catalog_side(enriched: str) -> str:
    return f"""
select category, brand, brand_type, count(*) as nb_references, {_count('is_available')} as nb_available,
    {_rnd('mean(price_eur)', 2)} as catalog_avg_price, {_rnd('median(price_eur)', 2)} as catalog_median_price,
    {_rnd('min(price_eur)', 2)} as catalog_min_price, {_rnd('max(price_eur)', 2)} as catalog_max_price,
    {_rnd('mean(reliability_score)', 3)} as avg_reliability_score, {_count('is_price_outlier')} as nb_price_outliers,
    {_count('nb_sources >= 2')} as nb_multi_source_refs
from {enriched} where price_eur is not null group by all"""


STEPS["catalog_side"] = _catalog_side("enriched")
STEPS["catalog_side_multi"] = _catalog_side("enriched_multi")

STEPS["market_side"] = f"""
select category, brand, count(*) as nb_listings, {_rnd('mean(asking_price_eur)', 2)} as market_avg_asking,
    {_rnd('mean(negotiated_price_eur)', 2)} as market_avg_negotiated,
    {_rnd('median(asking_price_eur)', 2)} as market_median_price,
    {_rnd('mean(discount_rate) * 100', 2)} as avg_discount_pct, {_rnd('mean(days_to_sell)', 1)} as avg_days_to_sell,
    {_count('is_fast_sale')} as nb_fast_sales, {_count("condition = 'new'")} as nb_new_condition,
    {_count("condition = 'reconditioned'")} as nb_reconditioned
from st_listings group by all"""

_GAP = f"""if(catalog_median_price > 0 and market_median_price > 0,
        {_rnd('(market_median_price - catalog_median_price) / catalog_median_price * 100', 2)}, null)
        as market_vs_catalog_pct,
    ['haute', 'moyenne', 'faible'][1 + ifnull((avg_days_to_sell > 7)::int + (avg_days_to_sell > 21)::int, 2)]
        as market_liquidity"""


def _pricing(catalog: str) -> str:
    return f"""
select category, brand, brand_type, {_zero('nb_references', 'nb_catalog_references')},
    {_zero('nb_available', 'nb_catalog_available')}, catalog_avg_price, catalog_median_price, catalog_min_price,
    catalog_max_price, avg_reliability_score, {_zero('nb_price_outliers', 'nb_catalog_price_outliers')},
    {_zero('nb_multi_source_refs', 'nb_multi_source_refs')}, {_zero('nb_listings', 'nb_market_listings')},
    market_avg_asking, market_avg_negotiated, market_median_price, avg_discount_pct, avg_days_to_sell,
    {_zero('nb_fast_sales', 'nb_fast_sales')}, {_GAP}
from {catalog} full join market_side using (category, brand)"""


STEPS["pricing"] = _pricing("catalog_side")
STEPS["pricing_multi"] = _pricing("catalog_side_multi")

STEPS["catalog_side_local"] = f"""
select category, brand, brand_type, count(*) as nb_references, {_count('is_available')} as nb_available,
    {_rnd('mean(price_eur)', 2)} as catalog_avg_price, {_rnd('median(price_eur)', 2)} as catalog_median_price,
    {_rnd('min(price_eur)', 2)} as catalog_min_price, {_rnd('max(price_eur)', 2)} as catalog_max_price,
    {_rnd('mean(quality_score)', 3)} as avg_quality_score
from s_parts_local where price_eur is not null group by all"""

STEPS["market_side_local"] = f"""
select category, brand, count(*) as nb_listings, {_rnd('mean(asking_price_eur)', 2)} as market_avg_asking,
    {_rnd('median(asking_price_eur)', 2)} as market_median_price,
    {_rnd('mean(discount_rate) * 100', 2)} as avg_discount_pct, {_rnd('mean(days_to_sell)', 1)} as avg_days_to_sell,
    {_count('is_fast_sale')} as nb_fast_sales
from s_listings_local group by all"""

STEPS["pricing_local"] = f"""
select category, brand, brand_type, {_zero('nb_references', 'nb_catalog_references')},
    {_zero('nb_available', 'nb_catalog_available')}, catalog_avg_price, catalog_median_price, catalog_min_price,
    catalog_max_price, avg_quality_score, {_zero('nb_listings', 'nb_market_listings')}, market_avg_asking,
    market_median_price, avg_discount_pct, avg_days_to_sell, {_zero('nb_fast_sales', 'nb_fast_sales')}, {_GAP}
from catalog_side_local full join market_side_local using (category, brand)"""

# --- coverage ---------------------------------------------------------------

# Labels of coverage and the scores they begin at.
_LEVEL = """case when coverage_score_pct >= 85 then 'couverture complète' when coverage_score_pct >= 60 then 'bonne couverture'
    when coverage_score_pct >= 40 then 'couverture partielle' else 'couverture faible' end as coverage_level"""

STEPS["by_vehicle"] = f"""
select vehicle_make, vehicle_model, vehicle_year, category, count(distinct part_number) as nb_distinct_parts,
    count(*) as nb_listings, {_rnd('mean(asking_price_eur)', 2)} as avg_price, count(distinct brand) as nb_brands,
    {_count("condition = 'new'")} as nb_new_parts, {_pct(_count("condition = 'new'"))} as new_parts_pct
from st_listings group by all"""


def _totals(source: str, *more: str) -> str:
    return f"""
select vehicle_make, vehicle_model, count(distinct vehicle_year) as years_covered,
    count(distinct category) as categories_covered, sum(nb_distinct_parts)::bigint as total_parts,
    sum(nb_listings)::bigint as total_listings, {_rnd('mean(avg_price)', 2)} as global_avg_price,
    {''.join(f'{m}, ' for m in more)}{_rnd('count(distinct category) * 100.0 / 7', 1)} as coverage_score_pct
from {source} group by all"""


STEPS["totals"] = _totals("by_vehicle", f"{_rnd('mean(nb_brands)', 1)} as avg_brands_per_category")


def _recalls_by(key: str) -> str:
    return f"""
select {key.format('vehicle_make')} as make_key, {key.format('vehicle_model')} as model_key,
    count(*) as recalls, sum(potentially_affected)::bigint as affected,
    {_count("severity = 'critique'")} as critical, count(distinct component_category) as components
from st_recalls group by all"""


_NORMAL = "upper(trim({}))"
STEPS["recalls_vehicle"] = _recalls_by("{}")
STEPS["recalls_vehicle_norm"] = _recalls_by(_NORMAL)


def _coverage_mart(recalls: str, key: str) -> str:
    return f"""
select t.*, {_zero('recalls', 'total_recalls')}, {_zero('affected', 'vehicles_affected_by_recalls')},
    {_zero('critical', 'critical_recalls')}, {_zero('components', 'recall_component_categories')}, {_LEVEL},
    coverage_score_pct < 60 and recalls is not null as is_coverage_opportunity
from totals t left join {recalls}
    on (make_key, model_key) = ({key.format('vehicle_make')}, {key.format('vehicle_model')})"""


STEPS["coverage"] = _coverage_mart("recalls_vehicle", "{}")
STEPS["coverage_norm"] = _coverage_mart("recalls_vehicle_norm", _NORMAL)

STEPS["by_vehicle_local"] = f"""
select vehicle_make, vehicle_model, vehicle_year, category, count(distinct part_number) as nb_distinct_parts,
    count(*) as nb_listings, {_rnd('mean(asking_price_eur)', 2)} as avg_price
from s_listings_local group by all"""

STEPS["coverage_loc"] = f"select *, {_LEVEL} from ({_totals('by_vehicle_local')})"

# --- suppliers --------------------------------------------------------------


_DISTINCTS = """count(distinct part_number) as nb_unique_refs, count(distinct category) as nb_categories,
    count(distinct brand) as nb_brands"""


def _supplier_perf(enriched: str) -> str:
    return f"""
select supplier, brand_type, {_DISTINCTS}, {_rnd('mean(price_eur)', 2)} as avg_price,
    {_rnd('mean(reliability_score)', 3)} as avg_reliability_score, {_count('is_available')} as nb_available_refs,
    {_count('is_price_outlier')} as nb_price_outliers, {_count('nb_sources >= 2')} as nb_validated_by_multi_source,
    {_pct(_count('is_available'))} as availability_rate_pct,
    {_pct(_count('nb_sources >= 2'))} as multi_source_validation_pct
from {enriched} where supplier is not null group by all"""


STEPS["supplier_perf"] = _supplier_perf("enriched")
STEPS["supplier_perf_multi"] = _supplier_perf("enriched_multi")

_TIER = """(select label from (values (1, 0.8, {first}, 'Tier 1 — Stratégique'), (2, 0.6, {second}, 'Tier 2 — Fiable'),
        (3, 0.4, 0, 'Tier 3 — À surveiller'), (4, -1, 0, 'Tier 4 — Risqué')) as tiers(rank, min_quality, min_rate, label)
    where {measure} >= min_quality and {rate} >= min_rate order by rank limit 1) as supplier_tier"""


def _suppliers(perf: str) -> str:
    outliers = """case when nb_price_outliers = 0 then 10 when nb_price_outliers / nb_unique_refs < 0.02 then 7
        when nb_price_outliers / nb_unique_refs < 0.05 then 4 else 0 end"""
    score = f"""(least(availability_rate_pct / 100, 1) * 35 + avg_reliability_score * 35
        + least(multi_source_validation_pct / 100, 1) * 20 + {outliers}) * 100"""
    tier = _TIER.format(first=80, second=60, measure="avg_reliability_score", rate="availability_rate_pct")
    return f"select *, {_rnd(score, 1)} as supplier_score, {tier} from {perf}"


STEPS["suppliers"] = _suppliers("supplier_perf")
STEPS["suppliers_multi"] = _suppliers("supplier_perf_multi")

STEPS["suppliers_local"] = f"""
select * exclude (quality, rate), {_TIER.format(first=80, second=0, measure='quality', rate='rate')}
from (select supplier, brand_type, {_DISTINCTS}, {_rnd('mean(price_eur)', 2)} as avg_price,
        {_rnd('mean(quality_score)', 3)} as avg_quality_score, {_count('is_available')} as nb_available_refs,
        {_pct(_count('is_available'))} as availability_rate_pct, {_rnd('mean(quality_score) * 100', 1)} as supplier_score,
        {_rnd('mean(quality_score)', 10)} as quality, {_count('is_available')} * 100.0 / count(*) as rate
      from s_parts_local where supplier is not null group by all)"""

# --- recall impact ----------------------------------------------------------

STEPS["recall_sums"] = """
select vehicle_make, component_category, severity, count(distinct recall_id) as nb_recalls,
    sum(potentially_affected)::bigint as total_vehicles_affected, count(distinct vehicle_model) as nb_models_affected,
    count(distinct model_year) as nb_years_affected
from st_recalls group by all"""


def _availability(key: str) -> str:
    return f"""
select {key.format('vehicle_make')} as make_key, {key.format('category')} as category_key,
    count(distinct part_number) as nb_parts, {_rnd('mean(asking_price_eur)', 2)} as avg_part_price,
    count(distinct brand) as nb_brands
from st_listings where condition <> 'used' group by all"""


STEPS["parts_available"] = _availability("{}")
STEPS["parts_available_norm"] = _availability(_NORMAL)


def _impact(available: str, key: str) -> str:
    demand = "total_vehicles_affected * share::double * ifnull(avg_part_price, assumed_price::double)"
    return f"""
select r.*, {_zero('nb_parts', 'nb_parts_in_catalog')}, avg_part_price, {_zero('nb_brands', 'nb_brands_covering')},
    severity in ('critique', 'majeur') and nb_parts is null as is_critical_gap,
    {_rnd(demand, 0)} as estimated_market_potential_eur
from recall_sums r
join (values ('critique', 0.8, 100), ('majeur', 0.6, 80), ('modéré', 0.3, 50), ('mineur', 0.3, 50))
    as demand(severity, share, assumed_price) using (severity)
left join {available} on (make_key, category_key) = ({key.format('vehicle_make')}, {key.format('component_category')})"""


STEPS["impact"] = _impact("parts_available", "{}")
STEPS["impact_norm"] = _impact("parts_available_norm", _NORMAL)

# --- feeds ------------------------------------------------------------------

STEPS["event_docs"] = """
select user_id::varchar as user_id, event_id, event_type, value, props, ts as ingested_at from events"""


def _newest_event(where: str) -> str:
    return f"""
select * exclude (rn) from (select *, row_number() over (partition by user_id order by ingested_at desc, event_id desc) as rn
    from event_docs where {where}) where rn = 1"""


STEPS["events_first"] = _newest_event(f"ingested_at < timestamp '{EVENTS_TO}'")
STEPS["events_second"] = _newest_event(f"ingested_at >= timestamp '{EVENTS_FROM}'")

STEPS["event_stats"] = f"""
select 'events' as collection, count_if(t.user_id is null)::bigint as inserted,
    count_if(b.ingested_at >= t.ingested_at and (b.event_id, b.event_type, b.value, b.props, b.ingested_at)
        is distinct from (t.event_id, t.event_type, t.value, t.props, t.ingested_at))::bigint as updated,
    0::bigint as errors,
    (select count(*) from event_docs where ingested_at >= timestamp '{EVENTS_FROM}') as total
from events_second b left join events_first t on b.user_id = t.user_id"""

_SHOWN = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def _feed(raw: str, key: str, ties: str, where: str = "true") -> str:
    return f"""
select * exclude (ts, rn, ingested_at, earliest), {_SHOWN.format('ts')} as ingested_at,
    case when earliest < timestamp '{SPLIT}' then '{FIRST_LOAD}.000000' else '{SECOND_LOAD}.000000' end as first_seen_at
from (select *, row_number() over (partition by {key} order by ts desc nulls last, {ties}) as rn,
        min(ts) over (partition by {key}) as earliest
      from (select *, {_DATED} from {raw} where {where})) where rn = 1"""


def _run(raw: str, collection: str, key: str, ties: str) -> str:
    """Statistics of an earlier and a later load of one feed."""
    columns = f"{key}, ts, {ties.replace(' desc nulls last', '')}"
    return f"""
select '{collection}' as collection, first_total, first_inserted, second_total, second_inserted, second_updated from (
    with docs as (select *, {_DATED}, ingested_at < '{SPLIT}' as early from {raw}),
    newest as (select * from (select *, row_number() over (partition by early, {key} order by ts desc, {ties}) as rn
        from docs) where rn = 1),
    a as (select {columns} from newest where early),
    b as (select {columns} from newest where not early)
    select (select count(*) from docs where early) as first_total, (select count(*) from a) as first_inserted,
        (select count(*) from docs where not early) as second_total,
        (select count(*) from b where {key} not in (select {key} from a)) as second_inserted,
        (select count(*) from b join a using ({key}) where b.ts >= a.ts and ({_pairs('b', columns)})
            is distinct from ({_pairs('a', columns)})) as second_updated)"""


def _pairs(side: str, columns: str) -> str:
    return ", ".join(f"{side}.{c.strip()}" for c in columns.split(","))


_PART_CONTENT = _newest_content(
    "part_number", "part_number_source", "brand", "brand_type", "category", "sub_category", "description",
    "price_eur", "currency", "stock_quantity", "availability", "vehicle_compatibility", "supplier", "source",
    "quality_score", "last_updated", "_fingerprint",
)
_LISTING_CONTENT = _newest_content(
    "part_number", "brand", "category", "vehicle_make", "vehicle_model", "vehicle_year", "asking_price_eur",
    "negotiated_price_eur", "seller_type", "seller_region", "condition", "days_to_sell", "listing_date", "source",
)
_RECALL_CONTENT = _newest_content(
    "manufacturer", "make", "model", "model_year", "component", "summary", "consequence", "remedy",
    "report_received_date", "record_creation_date", "potentially_affected", "source", "_raw",
)

STEPS["runs"] = " union all ".join(f"select * from ({sql})" for sql in (
    _run("raw_parts", "parts_catalog", "part_id", _PART_CONTENT),
    _run("raw_listings", "market_listings", "listing_id", _LISTING_CONTENT),
    _run("raw_recalls", "vehicle_recalls", "recall_id", _RECALL_CONTENT),
))

# --- queries ----------------------------------------------------------------

_DAY = f"{int(RUN_DATE[:4])} as {{0}}year, {int(RUN_DATE[5:7])} as {{0}}month, {int(RUN_DATE[8:])} as {{0}}day"
_EXPORTED = _DAY.format("export_") + ", " + _DAY.format("")


def _select(step: str) -> str:
    return f"select * from {step}"


_FACTS = """lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey"""
_MADE = f"upper(left(p_name, 3)) || '-' || upper(left(p_type, 2)) || '-' || {_KEY}"
_PARTS_REPORT = f"select p_partkey, p_brand as brand, p_type as category, {_MADE} as part_number from part"


def _not_null(model: str, step: str, *columns: str) -> str:
    return " union all ".join(
        f"""select '{model}' as model, '{c}' as "column", 'not_null' as test,
        count(*) filter (where {c} is null) as failures from {step}""" for c in columns
    )


def _unique(model: str, step: str, column: str) -> str:
    return f"""select '{model}', '{column}', 'unique', count(*)
        from (select {column} from {step} where {column} is not null group by 1 having count(*) > 1)"""


def _accepted(model: str, step: str, column: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"""select '{model}', '{column}', 'accepted_values', count(*)
        from (select distinct {column} from {step} where {column} not in ({listed}))"""


_NOT_NULL = " union all ".join([
    _not_null("stg_parts_catalog", "st_parts", "part_id", "part_number", "price_eur"),
    _not_null("stg_market_listings", "st_listings", "listing_id", "asking_price_eur"),
    _not_null("stg_vehicle_recalls", "st_recalls", "recall_id"),
])

def _fields(first_seen: str) -> str:
    """Each field from the newest event that has it; an event that lacks one has null there."""
    newest = lambda c, has: f"arg_max({c}, (ingested_at, {c})) filter (where {c} is not null and {has}) as {c}"
    return f"""
select user_id, {newest('event_id', 'true')}, {newest('event_type', 'true')}, {newest('value', 'event_id % 2 <> 0')},
    {newest('props', 'event_id % 3 <> 0')}, {_SHOWN.format('max(ingested_at)')} as ingested_at, {first_seen} as first_seen_at
from event_docs group by user_id"""


QUERIES: dict[str, str] = {
    "bronze_read_documents": _select("raw_recalls"),
    "bronze_read_spellings": _select("raw_listings"),
    "bronze_drop_internal": "select * exclude (_raw) from raw_recalls",
    "bronze_date_stamp": f"select *, {_DAY.format('export_')} from raw_listings",
    "bronze_export_json": f"""select *, {_EXPORTED},
        (select count(*) from raw_parts) as documents_written from raw_parts""",
    "bronze_nested_to_json": _select("raw_parts"),
    "bronze_write_parquet": "select * exclude (_raw) from raw_recalls",
    "bronze_read_json": f"""select * exclude (d), {int(RUN_DATE[:4])} as export_year, {int(RUN_DATE[5:7])} as export_month, d as export_day,
        {int(RUN_DATE[:4])} as "year", {int(RUN_DATE[5:7])} as "month", d as "day"
        from (select *, case when ingested_at < '{SPLIT}' then {int(EARLIER_RUN_DATE[8:])} else {int(RUN_DATE[8:])} end as d
              from raw_listings) t""",
    "scan_parquet": _select("s_parts"),
    "silver_write_partitioned": _select("s_listings"),
    "silver_write_flat": _select("s_recalls"),
    "silver_run": """
        select 'parts_catalog' as dataset, count(*) as n_rows, count(*) as n_written from s_parts
        union all select 'market_listings', count(*), count(*) from s_listings
        union all select 'vehicle_recalls', count(*), count(*) from s_recalls""",
    "silver_run_parts": _select("s_parts"),
    "silver_run_listings": _select("s_listings"),
    "silver_run_recalls": _select("s_recalls"),
    "silver_update_parts": _select("s_parts"),
    "silver_update_listings": _select("s_listings"),
    "silver_update_recalls": _select("s_recalls"),
    "gold_run_suppliers": _select("suppliers"),
    "gold_run_pricing": _select("pricing"),
    "gold_run_coverage": _select("coverage"),
    "gold_run_impact": _select("impact"),
    "gold_materialize": f"select *, '{RUN_TS.replace('T', ' ')}' as updated_at from pricing",
    "gold_export_parquet": _select("suppliers_local"),
    "gold_export_pricing": _select("pricing_local"),
    "gold_export_coverage": _select("coverage_loc"),
    "gold_read_mart": _select("coverage_loc"),
    "local_run": _select("pricing_local"),
    "gold_run": " union all ".join(
        f"select '{mart}' as mart, count(*) as n_rows from {step}" for mart, step in (
            ("mart_market_pricing", "pricing"), ("mart_catalog_coverage", "coverage"),
            ("mart_supplier_performance", "suppliers"), ("mart_recall_impact", "impact"))),
    "catalog_register": """select part_id, part_number, brand, category, price_eur, source,
        left(ingested_at, 10) as ingested_date, ingested_year, ingested_month from s_parts""",
    "ingest_upsert": f"""
        select coalesce(t.user_id, b.user_id) as user_id,
            case when {{take}} then b.event_id else t.event_id end as event_id,
            case when {{take}} then b.event_type else t.event_type end as event_type,
            case when {{take}} then b.value else t.value end as value, t.props,
            {_SHOWN.format('case when {take} then b.ingested_at else t.ingested_at end')} as ingested_at,
            case when t.user_id is not null then '{FIRST_LOAD}.000000' else '{SECOND_LOAD}.000000' end as first_seen_at
        from events_first t full join events_second b on t.user_id = b.user_id""".replace(
        "{take}", "(b.user_id is not null and (t.user_id is null or b.ingested_at >= t.ingested_at))"),
    "ingest_stats": _select("event_stats"),
    "ingest_stream_upsert": f"""
        select d.user_id, d.event_id, d.event_type, d.value, d.props, {_SHOWN.format('d.ingested_at')} as ingested_at,
            {_SHOWN.format('f.first_seen')} as first_seen_at
        from (select *, row_number() over (partition by user_id order by ingested_at desc, event_id desc) as rn
              from event_docs) d
        join (select user_id, min(ingested_at) as first_seen from event_docs group by 1) f on d.user_id = f.user_id
        where d.rn = 1""",
    "ingest_fields_batch": _fields(
        f"case when min(ingested_at) < '{EVENTS_TO}' then '{FIRST_LOAD}.000000' else '{SECOND_LOAD}.000000' end"),
    "ingest_fields_late": _fields(
        f"case when max(ingested_at) >= '{EVENTS_TO}' then '{FIRST_LOAD}.000000' else '{SECOND_LOAD}.000000' end"),
    "ingest_quarantine": """
        select * from (with spoilt as (select *, event_id % 97 = 0 as cut, event_id % 89 = 0 as keyless, event_id % 83 = 0 as wordy
            from event_docs),
        found as (
            select 'no document' as reason, null::varchar as field, event_id from spoilt where cut
            union all select 'no key', 'user_id', event_id from spoilt where keyless and not cut
            union all select 'value', 'value', event_id from spoilt where wordy and not cut)
        select reason, field, count(*) as n, count(distinct event_id) as contents, count(*) as with_file,
            (select count(distinct user_id) from spoilt where not cut and not keyless) as inserted,
            (select count(*) from spoilt where cut) as errors, (select count(*) from spoilt) as total
        from found group by 1, 2)""",
    "ingest_fields_stream": _fields(_SHOWN.format("min(ingested_at)")),
    "ingest_run_recalls": _feed("raw_recalls", "recall_id", _RECALL_CONTENT),
    "ingest_feed_parts": _feed("raw_parts", "part_id", "part_number"),
    "ingest_feed_listings": _feed("raw_listings", "listing_id", _LISTING_CONTENT),
    "ingest_feed_recalls": _feed(
        "raw_recalls", "recall_id", _RECALL_CONTENT,
        f"make in ({', '.join(repr(m) for m in FEED_MAKES)}) and model_year in ({', '.join(str(y) for y in FEED_YEARS)})"),
    "ingest_run": """
        select 'ingestion_20240304_010000' as run_id, 'success' as status,
            cast(sum(first_total) over () as bigint) as total_docs, collection, first_inserted as inserted,
            0::bigint as updated, 0::bigint as errors, first_total as total from runs
        union all select 'ingestion_20240305_010000', 'success', cast(sum(second_total) over () as bigint), collection,
            second_inserted, second_updated, 0, second_total from runs""",
    "run_log_append": f"""
        select 'ingestion_20240304_010000' as run_id, 'ingestion' as dag_id, 'success' as status, total as total_docs,
            inserted, updated, '{FIRST_LOAD}' as recorded_at from event_stats
        union all select 'ingestion_20240305_010000', 'ingestion', 'success', total, 0, 0, '{SECOND_LOAD}'
        from event_stats""",
    "export_summary": """
        select collection, cast(sum(n) as bigint) as documents from (
            select 'parts_catalog' as collection, count(*) as n from raw_parts
            union all select 'market_listings', count(*) from raw_listings
            union all select 'vehicle_recalls', count(*) from raw_recalls) group by rollup (collection)""",
    "key_part_number": _PARTS_REPORT,
    "key_part_number_variant": f"""select *, replace(part_number, '-', ' ') as part_number_source
        from ({_PARTS_REPORT})""",
    "key_fingerprint": f"select *, md5(part_number || ':' || brand) as _fingerprint from ({_PARTS_REPORT})",
    "parts_compatibility_build": f"""
        select part_number, to_json(list({{'make': make, 'model': model, 'year_from': year_from, 'year_to': year_to}}
            order by make, model, year_from, year_to))::varchar as vehicle_compatibility
        from (select 'P' || l_partkey as part_number, n_name as make, c_mktsegment as model,
                cast(min(year(o_orderdate)) as integer) as year_from, cast(max(year(o_orderdate)) as integer) as year_to
              from {_FACTS} group by 1, 2, 3) group by part_number""",
    "parts_description": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand || ' ' || p_type || ' pour ' || s_name as description
        from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey""",
    "recall_normalize": f"""
        select recall_id, case when model_year > 1980 then manufacturer else make end as manufacturer, make, model,
            model_year, component, '' as summary,
            case when component like 'S%' then consequence when component <> 'Carburant' then 'Fire' else '' end
                as consequence,
            remedy, report_received_date, '' as record_creation_date,
            coalesce(potentially_affected, 0) as potentially_affected, 'nhtsa_api' as source, '{RUN_TS}' as ingested_at
        from raw_recalls""",
    "complaint_normalize": f"""
        select event_id::varchar as complaint_id, 'MAKE ' || (user_id % 10) as make, 'Model ' || (user_id % 7) as model,
            cast(year(ts) as integer) as model_year, case when value > 5 then event_type else '' end as component,
            coalesce(props, '') as description, value > 20 as crash, false as fire,
            case when value > 15 then cast(floor(value) as integer) else 0 end as injuries, 0 as deaths,
            strftime(ts, '%d/%m/%Y') as date_of_incident, '' as date_added, 'nhtsa_api' as source,
            '{RUN_TS}' as ingested_at
        from events""",
    "silver_parts": _select("s_parts"),
    "silver_recalls": _select("s_recalls"),
    "silver_listings": _select("s_listings"),
    "silver_parts_local": _select("s_parts_local"),
    "silver_listings_local": _select("s_listings_local"),
    "silver_listings_scheduled": _select("s_listings_scheduled"),
    "stg_parts": _select("st_parts"),
    "stg_listings": _select("st_listings"),
    "stg_recalls": _select("st_recalls"),
    "int_price_stats": "select category, brand_type, "
    + ", ".join(f"{_rnd(c, 6)} as {c}" for c in ("q1", "median_price", "q3", "avg_price", "stddev_price"))
    + ", parts_count from price_stats",
    "int_source_coverage": f"""select * exclude (avg_price_cross_source),
        {_rnd('avg_price_cross_source', 6)} as avg_price_cross_source from source_coverage""",
    "int_source_coverage_multisource": f"""select * exclude (avg_price_cross_source),
        {_rnd('avg_price_cross_source', 6)} as avg_price_cross_source from quote_coverage""",
    **{
        f"int_parts_enriched{suffix}": "select * replace ("
        + ", ".join(f"{_rnd(c, 6)} as {c}" for c in (
            "category_median_price", "category_avg_price", "category_q1", "category_q3"))
        + f") from {step}"
        for suffix, step in (("", "enriched"), ("_multisource", "enriched_multi"))
    },
    "int_price_outlier": """
        select part_id, price_eur, coalesce(price_eur < q1 - 0.5::double * (q3 - q1)
            or price_eur > q3 + 0.5::double * (q3 - q1), false) as is_price_outlier
        from st_quotes c left join price_stats ps on c.category = ps.category and c.brand_type = ps.brand_type""",
    "int_reliability_score": "select part_id, reliability_score from enriched_multi",
    "pricing_catalog_side": _select("catalog_side"),
    "pricing_market_side": _select("market_side"),
    "supplier_sketches": """select supplier, brand_type, count(*) as n_rows, true as count_near,
        case when count(price_eur) > 0 then true end as median_near
        from st_quotes where supplier is not null group by all""",
    "mart_market_pricing": _select("pricing"),
    "mart_market_pricing_multisource": _select("pricing_multi"),
    "mart_market_pricing_local": _select("pricing_local"),
    "coverage_by_vehicle": _select("by_vehicle"),
    "coverage_totals": _select("totals"),
    "recalls_by_vehicle": """select make_key as vehicle_make, model_key as vehicle_model, recalls as total_recalls,
        affected as total_vehicles_affected, critical as critical_recalls,
        components as affected_component_categories from recalls_vehicle""",
    "mart_catalog_coverage": _select("coverage"),
    "mart_catalog_coverage_normkey": _select("coverage_norm"),
    "mart_catalog_coverage_local": _select("coverage_loc"),
    "supplier_catalog_perf": _select("supplier_perf"),
    "seller_market_perf": f"""
        select seller_type as supplier_type, seller_region, count(*) as nb_transactions,
            {_rnd('mean(asking_price_eur)', 2)} as avg_asking_price,
            {_rnd('mean(discount_rate) * 100', 2)} as avg_discount_pct, {_rnd('avg(days_to_sell)', 1)} as avg_days_to_sell,
            {_pct(_count('is_fast_sale'))} as fast_sale_rate_pct,
            count(distinct vehicle_make) as nb_vehicle_makes_covered, count(distinct category) as nb_categories_covered
        from st_listings group by seller_type, seller_region""",
    "mart_supplier_performance": _select("suppliers"),
    "mart_supplier_performance_multisource": _select("suppliers_multi"),
    "mart_supplier_performance_local": _select("suppliers_local"),
    "recall_summary": _select("recall_sums"),
    "recall_parts_availability": """select make_key as vehicle_make, category_key as component_category,
        nb_parts as nb_parts_available, avg_part_price, nb_brands as nb_brands_available from parts_available""",
    "mart_recall_impact": _select("impact"),
    "mart_recall_impact_normkey": _select("impact_norm"),
    "dq_not_null": _NOT_NULL,
    "dq_unique": """select listing_id as value, count(*) as n from raw_listings
        where listing_id is not null group by 1 having count(*) > 1""",
    "dq_accepted_values": """select availability as value, count(*) as n from raw_parts
        where availability not in ('in_stock', 'on_order', 'discontinued') group by 1""",
    "dq_report": " union all ".join([
        _NOT_NULL,
        _unique("stg_parts_catalog", "st_parts", "part_id"),
        _unique("stg_market_listings", "st_listings", "listing_id"),
        _unique("stg_vehicle_recalls", "st_recalls", "recall_id"),
        _accepted("stg_parts_catalog", "st_parts", "availability", "in_stock", "on_order", "discontinued"),
        _accepted("stg_parts_catalog", "st_parts", "brand_type", "OEM", "COMPAT"),
        _accepted("stg_market_listings", "st_listings", "condition", "new", "reconditioned", "used"),
        _accepted("stg_vehicle_recalls", "st_recalls", "severity", "critique", "majeur", "modéré", "mineur"),
    ]),
    "dq_no_negative_prices": "select count(*) as failures from enriched where price_eur < 0",
    "dq_reliability_bounded":
        "select count(*) as failures from enriched where reliability_score < 0 or reliability_score > 1",
    "dq_gold_validate": """
        select 'negative_median_price' as "check", count(*) as failures from pricing_local where catalog_median_price < 0
        union all select 'coverage_score_out_of_bounds', count(*) from coverage_loc
        where coverage_score_pct < 0 or coverage_score_pct > 100""",
    "kpi_overview": f"""
        select cast(sum(nb_catalog_references) as bigint) as catalog_references,
            {_rnd('avg(avg_quality_score)', 6)} as avg_quality,
            cast(sum(nb_market_listings) as bigint) as market_listings,
            (select count(*) from (select distinct vehicle_make from coverage_loc)) as vehicle_makes
        from pricing_local""",
    "top_categories": """
        select * from pricing_local where catalog_median_price is not null
        order by nb_catalog_references desc, category nulls first, brand nulls first, brand_type nulls first limit 8""",
    "catalog_vs_market": """
        select *, max(greatest(catalog_median_price, market_median_price)) over () as axis_max from pricing_local
        where catalog_median_price is not null and market_median_price is not null""",
    "pricing_category_list": "select distinct category from pricing_local where category is not null",
    **{
        name: f"""select category, brand, nb_catalog_references, catalog_median_price, market_median_price,
            market_vs_catalog_pct, avg_quality_score from pricing_local where {where}"""
        for name, where in (("pricing_by_category", "category = 'Freinage'"), ("pricing_by_category_all", "true"))
    },
    "pricing_long": """
        select category, brand, brand_type, 'catalog_median_price' as price_source, catalog_median_price as price
        from pricing_local where catalog_median_price is not null
        union all select category, brand, brand_type, 'market_median_price', market_median_price
        from pricing_local where catalog_median_price is not null""",
    "liquidity_counts": "select market_liquidity, count(*) as n from pricing_local group by 1",
    **{
        name: f"""select *, coverage_score_pct >= 80 as meets_target from coverage_loc
            order by total_parts desc, vehicle_make nulls first, vehicle_model nulls first limit {n}"""
        for name, n in (("coverage_top", 10), ("coverage_top20", 20))
    },
    "coverage_vs_volume": "select vehicle_make, coverage_score_pct, total_parts, total_listings from coverage_loc",
    "supplier_kpis": f"""
        select count(*) filter (where supplier_tier like 'Tier 1%') as tier_1_suppliers,
            {_rnd('avg(avg_quality_score)', 6)} as avg_quality,
            {_rnd('avg(availability_rate_pct)', 6)} as avg_availability_pct from suppliers_local""",
    "supplier_top10": """select * from suppliers_local
        order by supplier_score desc nulls last, supplier nulls first, brand_type nulls first limit 10""",
    "supplier_quadrants": """
        select case when avg_quality_score >= 0.7 then 'reliable' else 'unreliable' end || '/' ||
            case when availability_rate_pct >= 70 then 'available' else 'scarce' end as quadrant,
            count(*) as n, cast(sum(nb_unique_refs) as bigint) as nb_unique_refs
        from suppliers_local group by 1""",
}


def _mentions(sql: str) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [name for name in STEPS if name in words]


def sql_of(query: str) -> str:
    """The query as one statement: its steps in order of definition, then its select."""
    body = QUERIES[query]
    needed, open_ = set(), _mentions(body)
    while open_:
        name = open_.pop()
        if name not in needed:
            needed.add(name)
            open_ += _mentions(STEPS[name])
    chain = ",\n".join(f"{name} as ({STEPS[name]})" for name in STEPS if name in needed)
    return f"with {chain}\n{body}" if chain else body
