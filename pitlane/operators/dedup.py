"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.schemas import PLACE


def latest_by(df: DataFrame, keys: list[str], newest: Column, ties: list[Column]) -> DataFrame:
    """Keep the row with the greatest ``newest`` per key; nulls count as one key.

    ``ties`` must make the order total, otherwise the survivor would depend on
    how rows were spread over tasks. Filtering ``row_number() = 1`` lets Spark
    plan a partial group limit: every map task reduces a key to one row before
    the shuffle, so a key holding a third of the table costs one row per task.

    Rows with a ``PLACE``, which their key implies, are grouped by both: shuffled
    by place already, they are neither shuffled nor sorted again.
    """
    placed = [PLACE] if PLACE in df.columns else []
    order = Window.partitionBy(*placed, *keys).orderBy(newest.desc_nulls_last(), *ties)
    return df.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") == 1).drop("_rn", *placed)


def content_order(columns: list[str]) -> list[Column]:
    """A total order over row contents, for tables whose key alone cannot break ties."""
    return [F.col(c).asc_nulls_first() for c in columns]
