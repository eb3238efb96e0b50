"""Business keys derived from other columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part_number(brand: Column, category: Column, index: Column) -> Column:
    """``BRA-CA-000042``: brand and category prefix plus the index padded to six digits.

    ``lpad`` would cut an index of more than six digits, so longer ones pass as they are.
    """
    digits = index.cast("string")
    padded = F.when(F.length(digits) >= 6, digits).otherwise(F.lpad(digits, 6, "0"))
    return F.concat(
        F.upper(F.substring(brand, 1, 3)), F.lit("-"), F.upper(F.substring(category, 1, 2)), F.lit("-"), padded
    )


def part_number_variant(number: Column) -> Column:
    """The spelling some sources use: blanks for dashes."""
    return F.translate(number, "-", " ")


def fingerprint(number: Column, brand: Column) -> Column:
    """md5 of ``number:brand``; null if either is, as ``concat`` is."""
    return F.md5(F.concat(number, F.lit(":"), brand))


def description(brand: Column, sub_category: Column, make: Column) -> Column:
    return F.concat(brand, F.lit(" "), sub_category, F.lit(" pour "), make)
