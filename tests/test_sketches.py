"""Sketches by day: their errors on skewed data, and what a new day reads."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitlane.operators import sketches
from pitlane.plans import pipeline
from pitlane.sources import linked

KEYS, PROBS = ["g"], {"q1": 0.25, "median": 0.5, "p99": 0.99}


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows in one group; a value that many share; heavy tails; a group of nulls."""
    u = (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) + 1) / 1_000_004.0
    return spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "nulls").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        (20240101 + F.col("id") % 4).cast("int").alias("day"), F.concat(F.lit("ref"), F.col("id") % 9001).alias("ref"),
        F.when(F.col("id") % 5 == 0, 42.0).otherwise(F.pow(u, -1.5)).alias("price"),
    ).withColumns({c: F.when(F.col("g") != "nulls", F.col(c)) for c in ("ref", "price")})


def test_errors(spark, rows, tmp_path):
    root = str(tmp_path / "s")
    for day in (20240103, 20240101, 20240104, 20240102, 20240101):  # one day comes twice
        written = pipeline.sketches_update(rows.where(F.col("day") == day), root, "day", KEYS, ["ref"], ["price"])
        assert written == {f"day={day}"}
    found = {r["g"]: r for r in pipeline.sketched(spark, root, KEYS, PROBS).collect()}
    values: dict[str, list] = {}
    for r in rows.select("g", "ref", "price").collect():
        values.setdefault(r["g"], []).append((r["ref"], r["price"]))
    assert set(found) == set(values)
    for group, held in values.items():
        assert found[group]["n_rows"] == len(held)
        if group == "nulls":
            assert found[group]["nb_ref"] == 0 and found[group]["median_price"] is None
            continue
        exact = len({ref for ref, _ in held})
        assert abs(found[group]["nb_ref"] - exact) <= 0.065 * exact
        prices = np.sort([p for _, p in held])
        for name, p in PROBS.items():
            low, high = (np.searchsorted(prices, found[group][f"{name}_price"], side) / len(prices) for side in ("left", "right"))
            assert low - 0.04 <= p <= high + 0.04, (group, name, low, high)


def test_a_new_day_reads_and_writes_itself_only(spark, rows, tmp_path):
    root = str(tmp_path / "s")
    pipeline.sketches_update(rows.where("day < 20240104"), root, "day", KEYS, ["ref"], ["price"])
    before = linked.manifest(spark, root)
    pipeline.sketches_update(rows.where("day = 20240104"), root, "day", KEYS, ["ref"], ["price"])
    after = linked.manifest(spark, root)
    assert {k for k, v in after.owners.items() if before.owners.get(k) != v} == {"day=20240104"}
    some = pipeline.sketched(spark, root, KEYS, PROBS, first=20240102, last=20240103).agg(F.sum("n_rows")).first()[0]
    assert some == rows.where("day between 20240102 and 20240103").count()


def test_no_rows(spark, rows):
    empty = sketches.daily_sketches(rows.limit(0), "day", KEYS, ["ref"], ["price"])
    assert sketches.estimates(sketches.merged_sketches(empty, KEYS), KEYS, PROBS).count() == 0
