"""What several operators share: bounded Arrow batches, bounded samples, worker caches, text cuts."""

from __future__ import annotations

import re
import tempfile
import unicodedata
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows of an Arrow batch. Whole texts travel in them, so a batch is also bounded in bytes.
BATCH_ROWS = 256
BATCH_BYTES = 16 << 20

#: White space that separates words in all contracts of this package: space and the controls 9 to 13.
WORD = "[^\\x20\\x09-\\x0D]+"

Work = Callable[[pa.RecordBatch], dict[str, list | pa.Array]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, whatever the case."""
    there = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in there:
            name += "_"
        there.add(name.lower())
        out.append(name)
    return out


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python workers can import it.

    Spark serves the file itself; no folder needs to be shared for it.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="pitlane-code-")) / "pitlane_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def small_batches(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of so many rows for what runs inside: for rows of a few numbers."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def map_batches(df: DataFrame, schema: str | StructType, start: Callable[[], Work], rows: int = BATCH_ROWS) -> DataFrame:
    """``df`` through Python, a bounded batch at a time; ``start`` runs once in each task.

    ``rows`` above ``BATCH_ROWS`` joins batches in the worker, as long as ``BATCH_BYTES`` allow.
    """
    small_batches(df.sparkSession)
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches if rows <= BATCH_ROWS else joined(batches, rows):
            yield pa.RecordBatch.from_pydict(work(batch), schema=arrow)

    return df.mapInArrow(run, schema)


def joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches as one, of at most ``rows`` rows and ``BATCH_BYTES`` bytes unless one alone has more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and (
            sum(b.num_rows for b in held) + batch.num_rows > rows or sum(b.nbytes for b in held) + batch.nbytes > BATCH_BYTES
        ):
            yield pa.concat_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def drawn(df: DataFrame, rows: int, *key: Column | str) -> DataFrame:
    """About ``rows`` rows, picked by a hash of ``key``: the same ones in every run, none moved.

    Only training samples and warm-up tables are drawn so; no result depends on
    a row being left out.
    """
    total = df.count()
    return df if total <= rows else df.filter(F.pmod(F.xxhash64(*key), F.lit(total)) < rows)


class Recent[T]:
    """A cache of bounded size in two generations: the older one goes when the newer is full."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict[str, T] = {}
        self.old: dict[str, T] = {}

    def get(self, key: str) -> T | None:
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: T) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


def cuts(text: str, size: int = 1 << 20) -> Iterator[str]:
    """``text`` in pieces of about ``size``, cut only before a space between two ASCII letters.

    No pre-token of the tokenizers used here reaches over such a place, so the
    pieces' pre-tokens are the text's.
    """
    start = 0
    while len(text) - start > size:
        place = _BETWEEN.search(text, start + size)
        if place is None:
            break
        yield text[start : place.start() + 1]
        start = place.start() + 1
    yield text[start:]


_BETWEEN = re.compile("[A-Za-z](?= [A-Za-z])")


def _unassigned() -> re.Pattern[str]:
    """Code points without a category here: libraries of another Unicode version may see letters."""
    ranges: list[list[int]] = []
    for code in range(0x110000):
        if unicodedata.category(chr(code)) == "Cn":
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]")


_UNASSIGNED: list[re.Pattern[str]] = []


def is_latin(text: str) -> bool:
    """All code points below 256: their classes are few enough to be written out."""
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return False


def has_unassigned(text: str) -> bool:
    if not _UNASSIGNED:
        _UNASSIGNED.append(_unassigned())
    return _UNASSIGNED[0].search(text) is not None


#: Letters, numbers and white space below code point 256, as \\p{L}, \\p{N} and \\s mean them.
LATIN_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
LATIN_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_SPACES = "\x09-\x0d \x85\xa0"


def latin_pattern(pattern: str) -> re.Pattern[str]:
    """``pattern`` for texts of code points below 256, its classes written out."""
    inside = pattern.replace("[^\\s\\p{L}\\p{N}]", f"[^{LATIN_SPACES}{LATIN_LETTERS}{LATIN_NUMBERS}]")
    for name, members in (("\\p{L}", LATIN_LETTERS), ("\\p{N}", LATIN_NUMBERS), ("\\s", LATIN_SPACES)):
        inside = inside.replace(f"[{name}]", name).replace(name, f"[{members}]")
    return re.compile(inside.replace("\\S", f"[^{LATIN_SPACES}]"))
