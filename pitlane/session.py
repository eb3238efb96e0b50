"""Session settings the jobs rely on.

Cluster sizing (executors, memory, ``spark.sql.shuffle.partitions``,
``spark.checkpoint.dir``) belongs to the cluster's own configuration and is
left alone here.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # ingested_at carries no zone; year/month must not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Of partitioned writes that do not say otherwise; silver is replaced as a whole.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}

SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
# Bytes of a table that one task of the medallion jobs reads. A row takes about 20 bytes in the stored base tables and
# 50 times that as a document that competes for its key, and a task sorts its documents: a split of the default size,
# 128 MB, would be 7 GB of them, of which nearly all is spilled.
SMALL_SPLIT = "8MB"

METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit"
# Bytecode of a generated method up to which Spark uses it. The JVM compiles no method above 8,000 bytes, so one for all
# columns of a document would be interpreted row by row; above this limit Spark generates a method for each few columns.
COMPILED_METHOD = "8000"

# Shuffled bytes that adaptive execution gives one task of these jobs. A line item widens in the reading task, as it does
# in the scanning one: the default of 64 MB is a million documents to sort.
SHUFFLED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SMALL_SHUFFLED = "8MB"

# Adaptive execution joins small partitions and splits none that a deduplication reads, so there must be enough to begin
# with. The session's own number stays unless the tables are too large for it.
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
STORED_BYTES_EACH = 8 << 20

_WIDENING = {SPLIT_BYTES: SMALL_SPLIT, METHOD_BYTES: COMPILED_METHOD, SHUFFLED_BYTES: SMALL_SHUFFLED}
_GIVEN: dict[str, dict[str, str | None]] = {}


def _set(spark: SparkSession, key: str, value: str | None) -> None:
    if value is None:
        spark.conf.unset(key)
    else:
        spark.conf.set(key, value)


def split_size(spark: SparkSession, widening: bool, stored_bytes: int = 0) -> None:
    """Small tasks and compiled methods for jobs that widen what they read, the session's own settings for others.

    ``stored_bytes`` of the largest table tell how many partitions its shuffles need.
    """
    given = _GIVEN.setdefault(
        spark.sparkContext.applicationId, {key: spark.conf.get(key, None) for key in [*_WIDENING, PARTITIONS]}
    )
    for key, value in (_WIDENING if widening else given).items():
        _set(spark, key, value)
    own = int(given[PARTITIONS] or spark.conf.get("spark.sql.shuffle.partitions"))
    needed = -(-stored_bytes // STORED_BYTES_EACH) if widening else 0
    _set(spark, PARTITIONS, str(needed) if needed > own else given[PARTITIONS])


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a table, none if there is no such table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(folder).getLength() if fs.exists(folder) else 0


def build_session(app_name: str = "pitlane", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
