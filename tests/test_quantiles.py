from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pitlane.operators import quantiles
from pitlane.operators.quantiles import aggregate_with_quantiles, quantiles_by_range, ranked_values

PROBS = {"q0": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99, "q4": 1.0}
RNG = np.random.default_rng(7)

GROUPS = {
    "one": [5.0],
    "two": [1.0, 2.0],
    "cents": np.round(RNG.uniform(1, 500, 997), 2).tolist(),
    "hot value": [42.0] * 700 + RNG.uniform(0, 100, 300).tolist(),
    "signs": RNG.normal(0, 50, 500).tolist(),
    "zeros": [0.0, -0.0] * 20 + [1e-9],
    "huge range": np.exp(RNG.uniform(-200, 200, 400)).tolist(),
    "adjacent doubles": (100 + np.arange(3000) * np.spacing(100.0)).tolist(),
    "one band": RNG.uniform(100, 100.0001, 2000).tolist(),
}


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(g, float(v)) for g, values in GROUPS.items() for v in values]
    rows += [(None, 3.0), (None, 9.0), ("cents", None), ("only nulls", None)]
    return spark.createDataFrame(rows, "g string, x double").repartition(5)


def check(result):
    got = {r["g"]: r for r in result.collect()}
    for group, values in {**GROUPS, None: [3.0, 9.0]}.items():
        for name, p in PROBS.items():
            assert got[group][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300), (group, name)
    return got


def test_by_range(frame):
    check(quantiles_by_range(frame, ["g"], "x", PROBS))


def test_one_exchange_moves_rows(frame, monkeypatch):
    """The range exchange, the counts of stretches and their running sums, and the few values found."""
    plans, store = [], quantiles.shared.store
    frame = store(frame, "frame")

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(quantiles.shared, "store", watched)
    found = quantiles_by_range(frame, ["g"], "x", PROBS)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    exchanges = [[line for line in plan.split("\n") if " Exchange " in line] for plan in plans]
    assert [len(e) for e in exchanges] == [1, 2, 1]
    assert "rangepartitioning" in exchanges[0][0] and not any("rangepartitioning" in line for e in exchanges[1:] for line in e)
    assert "BroadcastHashJoin" in plans[2] and "SortMergeJoin" not in plans[2]


def test_a_value_of_most_rows_is_spread(spark):
    rows = spark.range(40_000).select(
        F.lit("a").alias("g"), F.when(F.col("id") % 10 < 9, 42.0).otherwise(F.col("id").cast("double")).alias("x"), "id"
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sizes = [r["count"] for r in ranked_values(rows, ["g"], "x", ["id"]).groupBy(F.shiftright("_at", 33)).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8
        got = quantiles_by_range(rows, ["g"], "x", {"median": 0.5, "p95": 0.95}, ["id"]).first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    values = [42.0 if i % 10 < 9 else float(i) for i in range(40_000)]
    assert (got["median"], got["p95"]) == tuple(np.quantile(values, [0.5, 0.95]))


def test_next_to_aggregates(frame):
    got = check(aggregate_with_quantiles(frame, ["g"], [F.count("*").alias("n")], "x", PROBS))
    assert got["cents"]["n"] == 998
    assert got["only nulls"]["n"] == 1 and got["only nulls"]["median"] is None


ODD = {
    "nan": [1.0, 2.0, 3.0, math.nan, math.nan], "all nan": [math.nan] * 3, "infinities": [-math.inf, 1.0, 2.0, math.inf],
    "all odd": [math.inf, math.nan, -math.inf, 0.0, 5.0, 5.0, 1e308, -1e308], "one nan": [math.nan], "ties": [2.0] * 4 + [3.0],
}


def test_odd_values_as_in_sql(spark):
    """NaN, infinities, ties and one-row groups, against an engine with its own quantiles."""
    frame = spark.createDataFrame([(g, v) for g, values in ODD.items() for v in values], "g string, x double")
    got = {r["g"]: r for r in aggregate_with_quantiles(frame, ["g"], [F.count("*").alias("n")], "x", PROBS).collect()}
    con = duckdb.connect()
    con.execute("create table t (g varchar, x double)")
    con.executemany("insert into t values (?, ?)", [(g, v) for g, values in ODD.items() for v in values])
    columns = ", ".join(f"quantile_cont(x, {p})" for p in PROBS.values())
    for group, *expected in con.execute(f"select g, {columns} from t group by g").fetchall():
        for name, value in zip(PROBS, expected):
            assert got[group][name] == pytest.approx(value, rel=1e-12, nan_ok=True), (group, name)


def test_approximate(frame):
    got = aggregate_with_quantiles(frame, ["g"], [], "x", {"median": 0.5}, approx_accuracy=10000)
    assert {r["g"]: r["median"] for r in got.collect()}["hot value"] == 42.0
