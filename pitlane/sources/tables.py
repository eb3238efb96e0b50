"""Silver and gold tables, and their registration in the catalog."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane import schemas as S
from pitlane.sources import linked, shared


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table; with its declared ``schema``, a missing or empty one reads as empty."""
    if schema is None:
        return spark.read.parquet(path)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def silver_write_partitioned(df: DataFrame, path: str, partitions: list[str] | None = None) -> int:
    """Replace a silver table, partitioned by month of ingestion; returns the rows written.

    The rebalance keeps each month in few files and lets adaptive execution
    split a month that holds most of the rows. The whole table is replaced:
    the surviving row of a key can move to another month, so replacing only the
    months written would leave its older version behind. Rows are counted in
    the writing stage itself, where a task repeated after a loss counts once.
    """
    partitions = partitions or S.SILVER_PARTITIONS
    rows = Observation()
    counted = df.hint("rebalance", *partitions).observe(rows, F.count(F.lit(1)).alias("n"))
    writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "snappy")
    with shared.releasing_shuffles(df.sparkSession):
        writer.partitionBy(*partitions).parquet(path)
    return rows.get["n"]


def silver_write_flat(df: DataFrame, path: str) -> None:
    with shared.releasing_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def gold_materialize(df: DataFrame, root: str, name: str, run_ts: Column | None = None) -> None:
    """Create or replace a mart, stamped with the time of the run.

    It is a new version of a linked table: readers see the old one until its
    manifest is there, versions being read stay, and a failed run leaves the
    old one as it was.
    """
    stamped = df.withColumn("updated_at", F.current_timestamp() if run_ts is None else run_ts)
    linked.commit(stamped, f"{root}/{name}")


def gold_export_parquet(spark: SparkSession, names: list[str], root: str, out: str) -> None:
    """Copy marts, one linked table each, so that readers of an export meet whole ones only."""
    for name in names:
        linked.commit(linked.read(spark, f"{root}/{name}"), f"{out}/{name}")


def gold_read_mart(spark: SparkSession, root: str, name: str, ordered: bool = True) -> DataFrame:
    """A mart in its reading order; one that was never built reads as empty."""
    mart = linked.read(spark, f"{root}/{name}")
    if mart is None:
        return spark.createDataFrame([], T.StructType([]))
    order = S.MART_ORDER.get(name.removesuffix("_local")) if ordered else None
    if order is None:
        return mart
    largest, ties = order
    return mart.orderBy(*[F.col(c).desc_nulls_last() for c in largest], *[F.col(c).asc_nulls_first() for c in ties])


def catalog_register(
    spark: SparkSession, name: str, schema: T.StructType, partitions: list[str], location: str
) -> DataFrame:
    """Register existing partitioned Parquet files as an external table, in place of an earlier registration only."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "EXTERNAL":
        raise ValueError(f"{name} is a table or view of its own")
    plain, name = name, ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))
    location = location.replace("\\", "\\\\").replace("'", "\\'")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{p}`" for p in partitions)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({keys}) LOCATION '{location}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(plain)


def latest_version(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest completely written version of a table kept as one folder per version."""
    done = _versions(spark, root)
    return spark.read.parquet(done[-1]) if done else None


def _versions(spark: SparkSession, root: str, name: str = "_SUCCESS") -> list[str]:
    """Folders of the complete versions, oldest first; of all that hold anything with another ``name``."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/version=*/{name}")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {status.getPath().getParent().toString() for status in fs.globStatus(pattern) or []}
    return sorted(found)


def write_next_version(df: DataFrame, root: str, keep: int = 3) -> str:
    """A new version above all there are, also above incomplete ones; then all but the newest ``keep`` are removed.

    Numbers count up whatever the clock says, and no version is written twice,
    so one that is being read stays whole.
    """
    spark = df.sparkSession
    there = _versions(spark, root, "*")
    number = 1 + max([int(v.rpartition("=")[2].split("_")[0]) for v in there], default=0)
    path = f"{root}/version={number:09d}"
    df.write.parquet(path)
    for old in _versions(spark, root)[:-keep]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(old)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return path


def run_log_append(record: DataFrame, path: str) -> None:
    """Append one run's audit row."""
    record.write.mode("append").parquet(path)
