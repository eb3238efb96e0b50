"""Raw collections: reading, landing as JSON or Parquet, reading back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane import schemas as S
from pitlane.sources import shared

INTERNAL = ["_id", "_raw"]
#: Documents in a file of an export. A compressed file is read by one task, so its size must not grow with the table.
EXPORT_ROWS = 200_000
#: Of gzip: 16 to 25 % larger than at the default level in less than half of its time, which is a third of an export's.
EXPORT_LEVEL = "THREE"


def bronze_read_documents(
    spark: SparkSession, location: str, collection: str, format: str = "json", **options: str
) -> DataFrame:
    """A raw collection as a table, always under its declared schema.

    JSON numbers arrive whether written as ``12``, ``12.0`` or ``"12"``. A line
    that is no JSON object becomes a row of nulls, see ``bronze_read_lines``.
    ``format`` may name any installed source, such as Parquet files or a
    document-store connector (with ``location`` as the database).
    """
    if format == "json":
        read = bronze_read_lines(spark, f"{location}/{collection}", S.BRONZE[collection], **options)
        return read.drop(S.PRESENT, S.CORRUPT)
    reader = spark.read.format(format).schema(S.BRONZE[collection]).options(**options)
    if format in ("parquet", "orc") and "path" not in options:
        return reader.load(f"{location}/{collection}")
    return reader.option("database", location).option("collection", collection).load()


def bronze_read_lines(
    spark: SparkSession, path: str, schema: T.StructType, folders: str = "", told: bool = False,
    columns: list[str] | None = None, **options: str,
) -> DataFrame:
    """JSON lines under ``schema``, with the names of the fields a document sent and the text of unusable lines.

    ``folders`` declares partition columns. ``told`` adds each line's file and
    the values that did not convert. ``columns`` reads only these fields of ``schema``.
    """
    lines = spark.read.schema(f"value string{folders}").text(path, wholetext=False)
    if told:
        lines = lines.select("*", F.col("_metadata.file_path").alias(S.FILE))
    return parsed_lines(lines.where(F.trim("value") != ""), schema, told, columns, **options)


def parsed_lines(
    lines: DataFrame, schema: T.StructType, told: bool = False, columns: list[str] | None = None, **options: str
) -> DataFrame:
    """``value`` as columns of ``schema``, ``_present`` and ``_corrupt_record``; other columns stay.

    ``told`` adds ``_unread``. A line is parsed once: as an expression the parser would be copied into each condition on
    a field, which the optimizer moves below it; no condition moves below ``explode``.
    """
    line = T.StructField(S.CORRUPT, T.StringType())
    declared = T.StructType([*_numbers_as_text(schema).fields, line])
    settings = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT, **options}
    others = [c for c in lines.columns if c != "value"]

    def parsed(fields: T.StructType) -> Column:
        return F.array(F.from_json("value", fields, settings))

    if columns is None:
        read = lines.select("*", F.explode(parsed(declared)).alias("_read"))
    else:
        schema = T.StructType([f for f in schema.fields if f.name in columns])
        few = T.StructType([*_numbers_as_text(schema).fields, line])
        # What is kept of a broken line depends on the field that it breaks in, so these are read with all fields.
        whole = F.transform(parsed(declared), lambda x: F.struct(*[x[f.name].alias(f.name) for f in few.fields]))
        broken = F.col("_few").isNull() | F.col(f"_few.{S.CORRUPT}").isNotNull()
        read = lines.select("*", F.explode(parsed(few)).alias("_few")).select(
            "*", F.explode(F.when(broken, whole).otherwise(F.array("_few"))).alias("_read")
        )
    corrupt = F.when(F.col("_read").isNull() | F.col(f"_read.{S.CORRUPT}").isNotNull(), F.col("value"))
    return read.select(
        *[_typed(F.col(f"_read.{f.name}"), f.dataType).alias(f.name) for f in schema.fields], *others,
        F.json_object_keys("value").alias(S.PRESENT), corrupt.alias(S.CORRUPT),
        *([_unread(schema).alias(S.UNREAD)] if told else []),
    )


def _unread(schema: T.StructType) -> Column:
    """Field to text, of fields with a number that is none."""
    found = []
    for f in schema.fields:
        sent = F.col(f"_read.{f.name}")
        lost = _lost(sent, f.dataType)
        if lost is not None:
            text = F.to_json(sent) if isinstance(f.dataType, (T.StructType, T.ArrayType)) else sent
            found.append(F.struct(F.lit(f.name).alias("field"), F.when(lost, text).alias("text")))
    if not found:
        return F.lit(None).cast("map<string, string>")
    return F.map_from_entries(F.filter(F.array(*found), lambda x: x["text"].isNotNull()))


def _lost(text: Column, dtype: T.DataType) -> Column | None:
    """Whether anything in ``text`` does not convert; ``None`` if all of it always does."""
    if isinstance(dtype, T.StructType):
        inside = [x for f in dtype.fields if (x := _lost(text[f.name], f.dataType)) is not None]
        return F.coalesce(F.greatest(*inside, F.lit(False)), F.lit(False)) if inside else None
    if isinstance(dtype, T.ArrayType):
        if _lost(F.lit(None), dtype.elementType) is None:
            return None
        return F.coalesce(F.exists(text, lambda x: _lost(x, dtype.elementType)), F.lit(False))
    if isinstance(dtype, T.NumericType):
        return text.isNotNull() & _typed(text, dtype).isNull()
    return None


def _numbers_as_text(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _numbers_as_text(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_numbers_as_text(dtype.elementType))
    return T.StringType() if isinstance(dtype, T.NumericType) else dtype


def _typed(text: Column, dtype: T.DataType) -> Column:
    """Text as the declared type; what is no number becomes null, a fraction of a whole number is cut."""
    if isinstance(dtype, T.StructType):
        fields = F.struct(*[_typed(text[f.name], f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(text.isNotNull(), fields)
    if isinstance(dtype, T.ArrayType):
        return F.transform(text, lambda x: _typed(x, dtype.elementType))
    if isinstance(dtype, T.LongType):
        return F.coalesce(text.try_cast(dtype), text.try_cast("double").try_cast(dtype))
    if isinstance(dtype, T.IntegralType):
        return text.try_cast("double").try_cast(dtype)
    return text.try_cast(dtype) if isinstance(dtype, T.NumericType) else text


def bronze_drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*INTERNAL)


def _day(run_date: str) -> dt.date:
    """Only ``YYYY-MM-DD``: other ISO forms would name other folders."""
    return dt.datetime.strptime(run_date, "%Y-%m-%d").date()


def bronze_date_stamp(df: DataFrame, run_date: str) -> DataFrame:
    day = _day(run_date)
    return df.withColumns({
        "export_year": F.lit(day.year), "export_month": F.lit(day.month), "export_day": F.lit(day.day),
    })


def bronze_export_json(df: DataFrame, root: str, collection: str, run_date: str) -> int:
    """Replace one day of a collection; returns the documents written, counted while writing.

    Field names are repeated in every document, so files are compressed, to about an eighth.
    """
    written = Observation(f"export_{collection}")
    stamped = bronze_date_stamp(df.drop("_id"), run_date).observe(written, F.count(F.lit(1)).alias("n"))
    folder = _day(run_date).strftime("year=%Y/month=%m/day=%d")
    write_lines(stamped, f"{root}/{collection}/{folder}")
    return written.get["n"]


def write_lines(df: DataFrame, path: str) -> None:
    """Replace a folder of compressed JSON lines."""
    writer = df.write.mode("overwrite").option("compression", "gzip").option("zlib.compress.level", EXPORT_LEVEL)
    with shared.releasing_shuffles(df.sparkSession):
        writer.option("maxRecordsPerFile", EXPORT_ROWS).json(path)


def bronze_read_json(
    spark: SparkSession, root: str, collection: str, run_date: str | None = None, columns: list[str] | None = None
) -> DataFrame:
    """All days of a collection, or the one of ``run_date`` (pruned by its folder); of its fields only ``columns``, if given."""
    export = [T.StructField(f"export_{p}", T.IntegerType()) for p in ("year", "month", "day")]
    schema = T.StructType([*S.BRONZE[collection].fields, *export])
    path = f"{root}/{collection}"
    df = bronze_read_lines(spark, path, schema, ", year int, month int, day int", columns=columns).drop(S.PRESENT, S.CORRUPT)
    if run_date is not None:
        day = _day(run_date)
        df = df.where((F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day))
    return df


def bronze_nested_to_json(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text (non-ASCII kept); flat columns unchanged."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.withColumns({
        f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, nested)
    })


def bronze_write_parquet(df: DataFrame, root: str, collection: str) -> bool:
    """One flat Parquet table per collection; an empty collection is skipped, its older table stays.

    Whether there are documents is seen in what was written, in a folder beside the table: asking the collection for a
    first one would run its shuffles twice.
    """
    spark, path = df.sparkSession, f"{root}/{collection}"
    beside = f"{root}/_{collection}-{uuid.uuid4().hex[:12]}"
    flat = bronze_nested_to_json(bronze_drop_internal(df))
    written, table = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (beside, path))
    fs = written.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        with shared.releasing_shuffles(spark):
            flat.write.parquet(beside)
        if spark.read.schema(flat.schema).parquet(beside).isEmpty():
            return False
        fs.delete(table, True)
        if not fs.rename(written, table):
            raise OSError(f"{beside} could not take the place of {path}")
        return True
    finally:
        fs.delete(written, True)
