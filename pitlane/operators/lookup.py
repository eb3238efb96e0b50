"""Join shapes shared by the enrichment and the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_lookup(rows: DataFrame, lookup: DataFrame, keys: list[str], spread_by: Column, spread: int = 32) -> DataFrame:
    """Left join of many rows to a lookup with one row per key, safe when few keys hold all rows.

    Each row of the lookup is repeated ``spread`` times, so a hot key is shared
    by that many tasks. As the salt is a join key, both sides are shuffled for
    the join itself, so adaptive execution splits a hot share further, or
    broadcasts the lookup once it has measured it.
    """
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(spread)).cast("int"))
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return salted_rows.join(salted_lookup, [*keys, "_salt"], "left").drop("_salt")


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join two tables grouped by the same keys; a null key matches a null key."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    match = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"_r_{k}"])
        match = same if match is None else match & same
    return left.join(renamed, match, how).drop(*[f"_r_{k}" for k in keys])
