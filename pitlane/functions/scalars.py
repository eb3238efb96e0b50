"""Column helpers. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(38,10)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c: Column | str, digits: int) -> Column:
    """Half-up rounding of a double through a decimal.

    Rounding the binary value directly depends on its last bit, which differs
    between engines and between summation orders; ten decimals absorb that.
    """
    return F.round(_col(c).try_cast(_EXACT), digits).cast("double")


def rnd_even(c: Column | str, digits: int) -> Column:
    """Half-even variant, for results that were rounded the numpy way."""
    return F.bround(_col(c).try_cast(_EXACT), digits).cast("double")


# The characters Python's str.strip removes.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_MARK = "\x01 "


def strip_ws(c: Column | str) -> Column:
    """Strip every kind of whitespace, where ``trim`` strips spaces only."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def title_case(c: Column | str) -> Column:
    """Capitalise after every non-letter (``initcap`` does it after blanks only, so each gets a marked blank)."""
    marked = F.regexp_replace(_col(c), r"([^\p{Lu}\p{Ll}\p{Lt}])", f"$1{_MARK}")
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def parse_ts(c: Column | str) -> Column:
    """ISO text to timestamp, null where it does not parse (ANSI mode would raise)."""
    return F.try_to_timestamp(_col(c))


def between_or_null(c: Column | str, keep: Column) -> Column:
    return F.when(keep, _col(c))


def clamp_unit(c: Column | str) -> Column:
    """Clamp to 0..1. ``least``/``greatest`` skip nulls, so an unknown value becomes 1.0."""
    return F.greatest(F.least(_col(c), F.lit(1.0)), F.lit(0.0))


def first_threshold(c: Column | str, steps: list[tuple[float, str]], otherwise: str, at_least: bool = True) -> Column:
    """Label of the first step the value reaches (``>=``, or ``<=`` if not ``at_least``); null falls through."""
    value = _col(c)
    label = None
    for bound, name in steps:
        hit = value >= bound if at_least else value <= bound
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise(otherwise)


def ratio_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` in percent of ``whole``; null for an empty whole."""
    return rnd(F.try_divide(part * F.lit(100.0), whole), digits)
