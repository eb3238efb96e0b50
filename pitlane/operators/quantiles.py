"""Exact quantiles per group from one range exchange, next to ordinary aggregates.

``percentile`` keeps every distinct value of a group in one task's memory. The
groups here are few (category x brand type), so that state would grow with the
table. Order statistics are read off a sorted table instead:

1. Rows, cut down to keys and value, are range-partitioned and sorted by keys,
   then value. That is the only exchange that moves rows. Each gets its place:
   the partition's number and, below it, the row's number there.
2. A group fills a stretch of places in each partition it is in. Stretches are
   counted, and running sums over a group's stretches give the rank each begins
   with. A group has at most one stretch for each partition.
3. So the rank that a quantile needs names one place, and the row at that place
   has the value. Places are few, two for each quantile of a group.

The sorted rows and the wanted places are stored in the shared folder, since
bounds of a range exchange are drawn anew each time it is planned.

Equal values lie side by side, so a value that very many rows share would fill
one partition. ``spread_by`` names columns that tell such rows apart.

NaN sorts above all numbers; nulls are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.operators.lookup import join_groups
from pitlane.sources import shared


def aggregate_with_quantiles(
    df: DataFrame, keys: list[str], aggregates: list[Column], value: str, probs: dict[str, float],
    approx_accuracy: int | None = None, spread_by: list[str] | None = None,
) -> DataFrame:
    """``aggregates`` per group and quantiles of ``value`` with linear interpolation, nulls ignored.

    ``probs`` names the quantile columns. ``approx_accuracy`` opts into
    approximate quantiles.
    """
    if approx_accuracy is None:
        return join_groups(df.groupBy(*keys).agg(*aggregates), quantiles_by_range(df, keys, value, probs, spread_by), keys)
    quantiles = F.percentile_approx(value, list(probs.values()), approx_accuracy)
    grouped = df.groupBy(*keys).agg(*aggregates, quantiles.alias("_q"))
    return grouped.withColumns({name: F.col("_q")[i] for i, name in enumerate(probs)}).drop("_q")


def ranked_values(df: DataFrame, keys: list[str], value: str, spread_by: list[str] | None = None) -> DataFrame:
    """``keys, _v, _at``: values in the order of ``_at`` within their group, and all over the table."""
    rows = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v"), F.xxhash64(*(spread_by or [F.lit(0)])).alias("_spread")
    )
    placed = rows.repartitionByRange(*keys, "_v", "_spread").sortWithinPartitions(*keys, "_v")
    return shared.store(placed.select(*keys, "_v", F.monotonically_increasing_id().alias("_at")), "ranked_values")


def quantiles_by_range(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], spread_by: list[str] | None = None
) -> DataFrame:
    ranked = ranked_values(df, keys, value, spread_by)
    part = F.shiftright("_at", 33)
    stretches = ranked.groupBy(*keys, part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select(
        "*", F.sum("_n").over(group).alias("_total"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    wanted = F.array_distinct(F.array(*[end(p) for p in probs.values() for end in (_lower, _upper)]))
    here = F.filter(wanted, lambda rank: (rank >= F.col("_start")) & (rank < F.col("_start") + F.col("_n")))
    places = stretches.select("_first", "_start", "_total", F.explode(here).alias("_rank"))
    places = shared.store(
        places.select((F.col("_first") + F.col("_rank") - F.col("_start")).alias("_at"), "_rank", "_total"), "wanted_places"
    )
    ends = ranked.join(places, "_at").groupBy(*keys).agg(
        *[F.max(F.when(F.col("_rank") == _lower(p), F.col("_v"))).alias(f"_lower_{name}") for name, p in probs.items()],
        *[F.max(F.when(F.col("_rank") == _upper(p), F.col("_v"))).alias(f"_upper_{name}") for name, p in probs.items()],
        F.max("_total").alias("_total"),
    )
    return ends.select(*keys, *[_interpolate(name, p).alias(name) for name, p in probs.items()])


def _position(p: float) -> Column:
    return F.lit(float(p)) * (F.col("_total") - 1)


def _lower(p: float) -> Column:
    return F.floor(_position(p))


def _upper(p: float) -> Column:
    return F.ceil(_position(p))


def _interpolate(name: str, p: float) -> Column:
    low, high = F.col(f"_lower_{name}"), F.col(f"_upper_{name}")
    share = _position(p) - _lower(p)
    return F.when(low == high, low).otherwise(low * (1 - share) + high * share)
