"""Records derived from raw tables and raw API answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parts_compatibility_build(fits: DataFrame, part_key: str = "part_number") -> DataFrame:
    """(part, make, model, year) rows to one array of vehicles with their year range per part.

    Years collapse to a range per vehicle before vehicles are collected, so an
    array holds distinct vehicles only, however many rows a part has.
    """
    ranges = fits.groupBy(part_key, "make", "model").agg(
        F.min("year").cast("int").alias("year_from"), F.max("year").cast("int").alias("year_to")
    )
    vehicle = F.struct("make", "model", "year_from", "year_to")
    return ranges.groupBy(part_key).agg(F.array_sort(F.collect_list(vehicle)).alias("vehicle_compatibility"))


def _parsed(raw: DataFrame, *fields: str) -> DataFrame:
    """The JSON text in ``_raw`` read once, each field as text; unreadable text has no fields."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    return raw.withColumn("_doc", F.from_json("_raw", schema))


def _text(field: str, default: Column | None = None) -> Column:
    return F.coalesce(F.col("_doc")[field], F.lit("") if default is None else default)


def _int(field: str) -> Column:
    return F.coalesce(F.col("_doc")[field].try_cast("int"), F.lit(0))


def _flag(field: str) -> Column:
    return F.coalesce(F.col("_doc")[field].try_cast("boolean"), F.lit(False))


def recall_normalize(raw: DataFrame, run_ts: str) -> DataFrame:
    """Campaign JSON (``_raw``) with its make, model and year to a flat recall row.

    Absent fields get a default. The consequence is read from its accented
    spelling first.
    """
    parsed = _parsed(
        raw, "NHTSACampaignNumber", "Manufacturer", "Component", "Summary", "Conséquence", "Consequence", "Remedy",
        "ReportReceivedDate", "RecordCreationDate", "PotentialNumberOfUnitsAffected",
    )
    return parsed.select(
        _text("NHTSACampaignNumber").alias("recall_id"),
        _text("Manufacturer", F.col("make")).alias("manufacturer"),
        "make", "model", "model_year",
        _text("Component").alias("component"),
        _text("Summary").alias("summary"),
        _text("Conséquence", _text("Consequence")).alias("consequence"),
        _text("Remedy").alias("remedy"),
        _text("ReportReceivedDate").alias("report_received_date"),
        _text("RecordCreationDate").alias("record_creation_date"),
        _int("PotentialNumberOfUnitsAffected").alias("potentially_affected"),
        F.lit("nhtsa_api").alias("source"),
        F.lit(run_ts).alias("ingested_at"),
        "_raw",
    )


def complaint_normalize(raw: DataFrame, run_ts: str) -> DataFrame:
    parsed = _parsed(
        raw, "odiNumber", "components", "complaint", "crash", "fire", "numberOfInjuries", "numberOfDeaths",
        "dateOfIncident", "dateAdded",
    )
    return parsed.select(
        _text("odiNumber").alias("complaint_id"),
        "make", "model", "model_year",
        _text("components").alias("component"),
        _text("complaint").alias("description"),
        _flag("crash").alias("crash"),
        _flag("fire").alias("fire"),
        _int("numberOfInjuries").alias("injuries"),
        _int("numberOfDeaths").alias("deaths"),
        _text("dateOfIncident").alias("date_of_incident"),
        _text("dateAdded").alias("date_added"),
        F.lit("nhtsa_api").alias("source"),
        F.lit(run_ts).alias("ingested_at"),
        "_raw",
    )
