from __future__ import annotations

from pitlane.operators import enrich


def test_source_coverage_counts_sets_and_multiplies_no_rows(spark):
    quotes = spark.createDataFrame(
        [("a", "x", "s1", 10.0), ("a", "x", "s2", 30.0), ("a", None, "s2", None), ("b", None, None, 5.0), (None, "x", "s1", 1.0)],
        "_fingerprint string, source string, supplier string, price_eur double",
    )
    coverage = enrich.int_source_coverage(quotes)
    assert "Expand" not in coverage._jdf.queryExecution().executedPlan().toString()
    found = {r["_fingerprint"]: (r["nb_sources"], r["nb_suppliers"], r["price_spread_ratio"]) for r in coverage.collect()}
    assert found == {"a": (1, 2, 2.0), "b": (0, 0, 0.0)}
    assert dict(coverage.dtypes)["nb_suppliers"] == "bigint"
