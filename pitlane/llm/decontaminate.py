"""Benchmark decontamination by templates: numbers, units and names become typed slots.

Texts are cut into words in lower case; a number becomes ``<num>``, a unit after
a number ``<unit>``, a capitalised word inside a sentence ``<name>``. Windows of
``WINDOW`` template words are hashed and joined with those of the benchmark. On
each alignment of a document with an item, matched windows are counted and the
slots compared: one filling of the item must always stand for one filling of the
document, as it does in a question with other numbers or names. A document is
contaminated by an item if enough windows match on one consistent alignment.

Windows are made where the documents lie. A bitmap of fixed size, set from the
benchmark's hashes, lets only windows through that may match; the join decides.
Joined rows are spread over ``SALTS`` shares of a window, so a passage in a
third of all documents doesn't meet in one task.

Nulls: null texts have no windows; null ids are kept. Repeated documents give
one row for each item and (``doc_id``, text). Items of equal templates are joined
once, and each of their fillings is tested; every item gets its rows. Windows with fewer than half literal words, and items with
fewer than ``LEAST_WORDS`` words, are no evidence. Other columns are not read.
Either table may be empty; the result then is.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm import common
from pitlane.sources import shared

#: Words of a window; matched windows that tell (or all the item has, if those are fewer); least words of an item.
WINDOW, ENOUGH, LEAST_WORDS = 8, 6, 5
#: Buckets of the bitmap.
BUCKETS = 1 << 20
SALTS = 16
CACHE_ENTRIES = 500_000

#: Units, as words after a number.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l gal s sec min h hr hrs ms w kw kwh v a hz khz mhz ghz b kb mb gb tb "
    "inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers gram grams kilogram "
    "kilograms pound pounds ounce ounces ton tons liter liters litre litres second seconds minute minutes hour hours day "
    "days week weeks month months year years dollar dollars cent cents euro euros percent degree degrees".split()
)
NUM, UNIT, NAME = "<num>", "<unit>", "<name>"

_PART = re.compile(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+")
_STOP = re.compile(r"[.!?:][\"')\]]*$")


def _capitalised(word: str) -> bool:
    return word[0].isupper() and len(word) > 1 and word[1:].islower()


def _chunk(chunk: str) -> tuple[list[tuple[str, str, bool]], bool]:
    """The parts of what stands between blanks: template word, own word, capitalised; and whether it ends a sentence."""
    parts = []
    for part in _PART.findall(chunk):
        if part[0].isdigit():
            parts.append((NUM, part, False))
        else:
            parts.append((part.lower(), part.lower(), _capitalised(part)))
    return parts, _STOP.search(chunk) is not None


class Words:
    """The words of a text, looked up when asked for."""

    def __init__(self, strings: list[str], index: np.ndarray):
        self.strings, self.index = strings, index

    def __len__(self) -> int:
        return len(self.index)

    def __getitem__(self, i: int) -> str:
        return self.strings[self.index[i]]


class Templates:
    """Template words of texts, as hashes, with the fillings of slots.

    What stands between blanks is taken apart once and numbered; a text is then
    an array of numbers, and slots are found in whole arrays. The numbering is
    begun anew when it has grown to ``CACHE_ENTRIES``.
    """

    def __init__(self):
        self.num, self.unit, self.name = (np.uint64(_hashed(s)) for s in (NUM, UNIT, NAME))
        self._begin()

    def _begin(self) -> None:
        self.ids: dict[str, int] = {}
        self.strings: list[str] = []
        # By chunk: its first part, number of parts, and whether it ends a sentence.
        self.first, self.n_parts = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ends = np.zeros(1024, bool)
        # By part: the hash of its template word; and whether it is a number, a unit's name, capitalised.
        self.codes = np.zeros(1024, np.uint64)
        self.number, self.named_unit, self.title = (np.zeros(1024, bool) for _ in range(3))

    def _number(self, new: list[str]) -> None:
        """Number chunks that were not seen before, all at once."""
        n_parts, ends, own, number, title = [], [], [], [], []
        for chunk in new:
            # Most are a word, alone or before one mark.
            word, last = (chunk, "") if chunk.isalpha() else (chunk[:-1], chunk[-1])
            if not last or (last in ",.;!?:" and word.isalpha()):
                n_parts.append(1)
                ends.append(last != "" and last in ".!?:")
                own.append(word.lower())
                number.append(False)
                title.append(_capitalised(word))
                continue
            parts, stop = _chunk(chunk)
            n_parts.append(len(parts))
            ends.append(stop)
            for template, part, capitalised in parts:
                number.append(template == NUM)
                own.append(part)
                title.append(capitalised)
        n, at = len(self.ids), len(self.strings)
        self.ids.update(zip(new, range(n, n + len(new))))
        self.strings += own
        counts = np.array(n_parts, np.int64)
        self.first = _put(self.first, n, at + np.cumsum(counts) - counts)
        self.n_parts, self.ends = _put(self.n_parts, n, counts), _put(self.ends, n, ends)
        codes = np.fromiter(map(xxhash.xxh64_intdigest, own), np.uint64, len(own))
        codes[np.array(number, bool)] = self.num
        self.codes = _put(self.codes, at, codes)
        self.number, self.title = _put(self.number, at, number), _put(self.title, at, title)
        self.named_unit = _put(self.named_unit, at, [word in UNITS for word in own])

    def of(self, text: str) -> tuple[np.ndarray, Words, np.ndarray]:
        """Hashes of the template words, the words themselves, and which are slots."""
        if len(self.ids) > CACHE_ENTRIES:
            self._begin()
        chunks: list[str] = []
        line_starts = []
        for line in text.split("\n"):
            line_starts.append(len(chunks))
            chunks += line.split()
        if not chunks:
            return np.zeros(0, np.uint64), Words(self.strings, np.zeros(0, np.int64)), np.zeros(0, bool)
        ids = np.fromiter(map(self.ids.get, chunks, repeat(-1)), np.int64, len(chunks))
        unseen = np.flatnonzero(ids < 0).tolist()
        if unseen:
            self._number(list(dict.fromkeys(chunks[i] for i in unseen)))
            ids[unseen] = [self.ids[chunks[i]] for i in unseen]
        first, n, ends = self.first[ids], self.n_parts[ids], self.ends[ids]
        starts_line = np.zeros(len(ids) + 1, bool)
        starts_line[line_starts] = True
        starts_line = starts_line[:-1]
        line = np.cumsum(starts_line)
        # A chunk begins a sentence at the start of a line, after a stop, or if all before it since then are empty.
        begins = starts_line.copy()
        begins[0] = True
        begins[1:] |= ends[:-1]
        if n.min() == n.max() == 1:
            part, opens = first, begins
        else:
            settled = begins.copy()
            settled[1:] |= n[:-1] > 0
            begins = begins[np.maximum.accumulate(np.where(settled, np.arange(len(ids)), 0))]
            of_chunk = np.repeat(np.arange(len(ids)), n)
            nth = np.arange(len(of_chunk)) - np.repeat(np.cumsum(n) - n, n)
            part, line, opens = first[of_chunk] + nth, line[of_chunk], (nth == 0) & begins[of_chunk]
        number = self.number[part]
        name = self.title[part] & ~opens
        unit = self.named_unit[part] & ~name
        unit[:1] = False
        unit[1:] &= number[:-1] & (line[1:] == line[:-1])
        codes = self.codes[part]
        codes[unit] = self.unit
        codes[name] = self.name
        return codes, Words(self.strings, part), number | name | unit


def _put(array: np.ndarray, at: int, values: np.ndarray | list[bool]) -> np.ndarray:
    """``array`` with ``values`` from place ``at`` on, doubled until they fit."""
    while at + len(values) > len(array):
        array = np.concatenate([array, np.zeros_like(array)])
    array[at : at + len(values)] = values
    return array


def _hashed(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


def rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` template words."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for j in range(size):
            total = (total ^ (total >> np.uint64(29))) * factor + codes[j : j + n]
        total ^= total >> np.uint64(32)
        total *= np.uint64(0xD6E8FEB86659FD93)
        total ^= total >> np.uint64(32)
    return total + np.uint64(size)


def _telling(slot: np.ndarray, size: int) -> np.ndarray:
    """Windows of which at least half the words are literal."""
    literal = np.concatenate(([0], np.cumsum(~slot)))
    return 2 * (literal[size:] - literal[:-size]) >= size


def _fillings(words: Words, slot: np.ndarray, at: int, size: int) -> list[str]:
    return [words[i] for i in range(at, at + size) if slot[i]]


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """One row for each window of each item.

    ``item_id, template, variant, n_windows, size, nth, item_at, window, fillings``; ``variant`` is a hash of all
    fillings, ``nth`` numbers the item's windows.
    """

    def start() -> common.Work:
        templates = Templates()

        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {name: [] for name in
                                    ("item_id", "template", "variant", "n_windows", "size", "nth", "item_at", "window",
                                     "fillings")}
            for item, text in zip(batch.column("item_id").to_pylist(), common.texts(batch), strict=True):
                codes, words, slot = templates.of(text)
                if len(codes) < LEAST_WORDS:
                    continue
                size = min(WINDOW, len(codes))
                hashes, telling = rolled(codes, size).view(np.int64), _telling(slot, size)
                places = np.flatnonzero(telling).tolist()
                template = xxhash.xxh64_intdigest(codes.tobytes()) - (1 << 63)
                variant = xxhash.xxh64_intdigest("\n".join(_fillings(words, slot, 0, len(codes)))) - (1 << 63)
                for nth, at in enumerate(places):
                    for name, value in (
                        ("item_id", item), ("template", template), ("variant", variant), ("n_windows", len(places)),
                        ("size", size), ("nth", nth), ("item_at", at), ("window", int(hashes[at])), ("fillings", _fillings(words, slot, at, size)),
                    ):
                        out[name].append(value)
            return out

        return work

    read = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    return common.map_batches(
        read, "item_id bigint, template bigint, variant bigint, n_windows int, size int, nth int, item_at int, "
        "window bigint, fillings array<string>", start,
    )


def document_windows(documents: DataFrame, sizes: list[int], bitmap: np.ndarray) -> DataFrame:
    """``doc_id, text_key, doc_at, window, filled``: windows of documents whose bucket is set."""
    shipped = documents.sparkSession.sparkContext.broadcast(np.packbits(bitmap))

    def start() -> common.Work:
        templates, bits = Templates(), np.unpackbits(shipped.value).astype(bool)

        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {name: [] for name in ("doc_id", "text_key", "doc_at", "window", "filled")}
            keys = batch.column("text_key").to_pylist()
            for doc, key, text in zip(batch.column("doc_id").to_pylist(), keys, common.texts(batch), strict=True):
                codes, words, slot = templates.of(text)
                for size in sizes:
                    hashes = rolled(codes, size)
                    hit = np.flatnonzero(bits[hashes & np.uint64(BUCKETS - 1)])
                    if len(hit):
                        hit = hit[_telling(slot, size)[hit]]
                    signed = hashes.view(np.int64)
                    for at in hit.tolist():
                        out["doc_id"].append(doc)
                        out["text_key"].append(key)
                        out["doc_at"].append(at)
                        out["window"].append(int(signed[at]))
                        out["filled"].append(_fillings(words, slot, at, size))
            return out

        return work

    read = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return common.map_batches(
        read.filter(F.col("text").isNotNull()),
        "doc_id bigint, text_key bigint, doc_at int, window bigint, filled array<string>", start,
    )


def _salted(small: DataFrame) -> DataFrame:
    return small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _matched(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``salt, doc_id, text_key, template, variant, n_matched, n_windows, n_slots``: consistent alignments.

    Windows meet one row for each template and place; the fillings of every
    variant of the template are then held against the document's.
    """
    places = items.dropDuplicates(["template", "nth"]).select("template", "n_windows", "nth", "item_at", "window", "size")
    # At most BUCKETS numbers and WINDOW sizes reach the driver, however large the benchmark is.
    bitmap = np.zeros(BUCKETS, bool)
    bitmap[[r[0] for r in places.select(F.expr(f"window & {BUCKETS - 1}").cast("int")).distinct().collect()]] = True
    sizes = sorted(r[0] for r in places.select("size").distinct().collect())
    windows = document_windows(documents, sizes, bitmap).withColumn(
        "salt", F.pmod("text_key", F.lit(SALTS)).cast("int")
    )
    aligned = windows.join(_salted(places.drop("size")), ["window", "salt"]).groupBy(
        "salt", "doc_id", "text_key", "template", "n_windows", (F.col("doc_at") - F.col("item_at")).alias("shift")
    ).agg(
        F.count_distinct("nth").alias("n_matched"),
        F.collect_set(F.struct("nth", "filled")).alias("met"),
    ).filter(F.col("n_matched") >= F.least(F.lit(ENOUGH), F.col("n_windows")))
    variants = items.dropDuplicates(["template", "variant", "nth"]).groupBy("template", "variant").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("nth", "fillings"))), lambda x: x["fillings"]).alias("given")
    )
    told = aligned.join(_salted(variants), ["template", "salt"]).withColumn(
        "slots", F.array_distinct(F.flatten(F.transform("met", lambda m: F.zip_with(
            F.col("given")[m["nth"]], m["filled"], lambda item, doc: F.struct(item.alias("item"), doc.alias("doc"))
        ))))
    )
    return told.filter(F.size("slots") == F.size(F.array_distinct(F.col("slots.item")))).select(
        "salt", "doc_id", "text_key", "template", "variant", "n_matched", "n_windows", F.size("slots").alias("n_slots")
    )


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each contaminated document and item: ``doc_id, text_key, item_id, n_matched, n_windows, n_slots``.

    ``text_key`` is ``xxhash64`` of the text; with ``doc_id`` it names a
    document even if ids repeat.
    """
    items = shared.store(benchmark_windows(benchmark), "benchmark_windows")
    named = items.select("template", "variant", "item_id").distinct()
    return _matched(documents, items).join(_salted(named), ["template", "variant", "salt"]).groupBy(
        "doc_id", "text_key", "item_id", "template"
    ).agg(
        F.max("n_matched").alias("n_matched"), F.max("n_windows").cast("bigint").alias("n_windows"),
        F.max("n_slots").cast("bigint").alias("n_slots"),
    ).drop("template")


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no item contaminates, with all their columns."""
    items = shared.store(benchmark_windows(benchmark), "benchmark_windows")
    found_id, found_key = common.fresh(documents, "_found_id", "_found_key")
    found = _matched(documents, items).select(F.col("doc_id").alias(found_id), F.col("text_key").alias(found_key)).distinct()
    match = F.col("doc_id").cast("bigint").eqNullSafe(F.col(found_id)) & (F.xxhash64("text") == F.col(found_key))
    return documents.join(found, match, "left_anti")
