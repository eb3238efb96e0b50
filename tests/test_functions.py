from __future__ import annotations

import hashlib
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitlane.functions import keys, rnd, rnd_even, strip_ws, title_case
from pitlane.functions.scalars import WHITESPACE
from pitlane.functions import clamp_unit, first_threshold, parse_ts, ratio_pct


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_rounding_is_half_up_on_the_decimal_value(spark):
    values = [1.005, 2.675, -1.005, 0.12345, 1e12, None]
    assert column(spark, values, "double", lambda c: rnd(c, 2)) == [1.01, 2.68, -1.01, 0.12, 1e12, None]


def test_rounding_half_even(spark):
    assert column(spark, [0.00005, 0.00015, 0.00025], "double", lambda c: rnd_even(c, 4)) == [0.0, 0.0002, 0.0002]


def test_rounding_out_of_range_is_null(spark):
    assert column(spark, [1e35, math.inf, math.nan], "double", lambda c: rnd(c, 2)) == [None, None, None]


TITLES = ["mercedes-benz", "citroën c4", "d'or 3x", "RENAULT", "a_b c", "  x", "", "été 205/55r16", "o'neill-smith", "a\x01 b\x01c", "東京ab"]


def test_title_case_follows_python(spark):
    assert column(spark, TITLES, "string", title_case) == [t.title() for t in TITLES]
    assert column(spark, [None], "string", title_case) == [None]


@settings(max_examples=15, deadline=None)
@given(words=st.lists(st.text(alphabet="abzAZéÉçÀ09-_'/ .", max_size=12), min_size=1, max_size=40))
def test_title_case_property(spark, words):
    assert column(spark, words, "string", title_case) == [w.title() for w in words]


@settings(max_examples=15, deadline=None)
@given(words=st.lists(st.text(alphabet="ab \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 ", max_size=10), min_size=1, max_size=40))
def test_strip_follows_python(spark, words):
    assert column(spark, words, "string", strip_ws) == [w.strip() for w in words]


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {c for c in map(chr, range(0x110000)) if c.isspace()}


def test_clamp_turns_unknown_into_one(spark):
    assert column(spark, [-0.5, 0.4, 1.7, None], "double", clamp_unit) == [0.0, 0.4, 1.0, 1.0]


def test_malformed_timestamps_are_null(spark):
    years = column(spark, ["2024-02-30T00:00:00", "soon", "", None, "2024-02-03T04:05:06.123456"], "string",
                   lambda c: F.year(parse_ts(c)))
    assert years == [None, None, None, None, 2024]


def test_thresholds(spark):
    steps = [(100, "a"), (10, "b")]
    assert column(spark, [100, 99, 10, 9, None], "int", lambda c: first_threshold(c, steps, "z")) == ["a", "b", "b", "z", "z"]


def test_ratio_of_nothing_is_null(spark):
    assert column(spark, [0, 4], "int", lambda c: ratio_pct(F.lit(1), c)) == [None, 25.0]


def test_part_number_keeps_long_indices(spark):
    made = column(spark, [42, 999999, 1234567], "bigint",
                  lambda c: keys.part_number(F.lit("Bosch"), F.lit("Câbles"), c))
    assert made == ["BOS-CÂ-000042", "BOS-CÂ-999999", "BOS-CÂ-1234567"]


def test_part_number_variant(spark):
    assert column(spark, ["A-B-1"], "string", keys.part_number_variant) == ["A B 1"]


@pytest.mark.parametrize("brand", ["Bosch", "Citroën"])
def test_fingerprint(spark, brand):
    expected = hashlib.md5(f"X-1:{brand}".encode()).hexdigest()
    assert column(spark, ["X-1", None], "string", lambda c: keys.fingerprint(c, F.lit(brand))) == [expected, None]
