"""Near-duplicates by SimHash: fingerprints embedded as bit counts of segments, joined on a grid.

1. A fingerprint's 64 bits are cut into ``SEGMENTS`` segments of ``WIDTH`` bits.
   The number of bits set in each segment makes a point. Two points are no
   further apart in Manhattan distance than their fingerprints in bits, since
   one flipped bit moves one coordinate by one. Counts are kept in unary (a
   segment's set bits moved to its low end), so the Manhattan distance of two
   points is the number of bits in which their codes differ.
2. Points within ``DISTANCE`` of each other are found on ``GRIDS`` grids, each
   over its own share of the coordinates: of a distance of at most 3, one of
   two halves has 1 at most. A point lies in the cell of its own coordinates and
   also visits the cells one step up in one coordinate, so both points of such
   a pair meet in a cell, where at least one is at home.
3. In a cell those within ``DISTANCE`` in all coordinates are compared exactly.
   A cell gives a forest of the links it found, at most one link a row: it has
   the same components as all of them. Cells of more than ``BLOCK`` rows are
   dealt out in pairs of blocks.
4. Components are labelled with the least ``doc_id`` in them.

Rows are what is linked: rows of one id and different texts are apart unless
their fingerprints are linked. Nulls and texts without words have fingerprint
zero, linked like any other. A row without ``doc_id`` links others and gets its
component's least id, null if there is none. Repeated rows get equal results,
an empty table an empty one. Other columns are not read. Long texts are hashed
whole, a bounded number of shingles at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pitlane.llm import common
from pitlane.llm.components import components
from pitlane.sources import shared

#: Words of a shingle and the seed of its hash.
WORDS, SEED = 3, 42
#: Fingerprints link at so many differing bits.
DISTANCE = 3
#: Segments of a fingerprint, and the grids that share them.
SEGMENTS, GRIDS = 32, 2
WIDTH = 64 // SEGMENTS
_BITS = 64 // GRIDS
#: Rows of a block; two blocks of a cell are compared in one piece. Cells up to SMALL rows are compared many at a time.
BLOCK, SMALL = 1024, 32
#: Shingles whose bits are counted at a time.
_AT_ONCE = 1 << 14

_LOW = np.uint64(sum(1 << WIDTH * i for i in range(SEGMENTS)))


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a text; words are parted by space and the controls 9 to 13."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= WORDS:
        return xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - WORDS + 1].tolist()
    ends = ends[WORDS - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), _AT_ONCE):
        hashes = np.array(
            [xxh64_intdigest(line[s:e], SEED) for s, e in zip(starts[i : i + _AT_ONCE], ends[i : i + _AT_ONCE], strict=True)],
            "<u8",
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def unary(fingerprints: np.ndarray) -> np.ndarray:
    """The embedding: each segment's set bits moved to its low end."""
    out = np.zeros_like(fingerprints)
    for i in range(WIDTH):
        # A bit comes in from below; a segment that is full up to there carries it one place up.
        carried = (fingerprints >> np.uint64(i)) & _LOW
        out |= ((out << np.uint64(1)) & ~_LOW & _spread(carried)) | carried
    return out


def _spread(low: np.ndarray) -> np.ndarray:
    """All bits of the segments whose lowest bit is set."""
    return low * np.uint64((1 << WIDTH) - 1)


def cells(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the cells that the points lie in or visit, each one's point, and whether it lies there."""
    keys, which, home = [], [], []
    mask = np.uint64((1 << _BITS) - 1)
    for grid in range(GRIDS):
        part = (points >> np.uint64(_BITS * grid)) & mask
        keys.append(_keyed(part, grid))
        which.append(np.arange(len(points)))
        home.append(np.ones(len(points), bool))
        for segment in range(SEGMENTS // GRIDS):
            full = np.uint64(((1 << WIDTH) - 1) << WIDTH * segment)
            rising = np.flatnonzero((part & full) != full)
            step = ((part[rising] & full) << np.uint64(1) | np.uint64(1 << WIDTH * segment)) & full
            keys.append(_keyed(part[rising] | step, grid))
            which.append(rising)
            home.append(np.zeros(len(rising), bool))
    return np.concatenate(keys).view(np.int64), np.concatenate(which), np.concatenate(home)


def _keyed(part: np.ndarray, grid: int) -> np.ndarray:
    return part * np.uint64(GRIDS) + np.uint64(grid)


def fingerprinted(documents: DataFrame) -> DataFrame:
    """``doc_id, code``: the fingerprint as a signed number."""

    def start() -> common.Work:
        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
            return {"doc_id": batch.column("doc_id"), "code": pa.array(found.view(np.int64))}

        return work

    read = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return common.map_batches(read, "doc_id bigint, code bigint", start)


def cell_rows(codes: DataFrame) -> DataFrame:
    """``key, code, home`` of every cell that a fingerprint of ``codes`` (``code``) lies in or visits."""

    def start() -> common.Work:
        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            code = batch.column("code").to_numpy()
            keys, which, home = cells(unary(code.view(np.uint64)))
            return {"key": pa.array(keys), "code": pa.array(code[which]), "home": pa.array(home)}

        return work

    return common.map_batches(codes.select("code"), "key bigint, code bigint, home boolean", start)


def _linked(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> np.ndarray:
    """Whether fingerprints are within the distance, by their points first."""
    near = np.bitwise_count(of_a ^ of_b) <= DISTANCE
    near[near] = np.bitwise_count(np.broadcast_to(a, near.shape)[near] ^ b[near]) <= DISTANCE
    return near


def _small(codes: np.ndarray, points: np.ndarray, home: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each row the least row it is connected with in its group; rows come group by group."""
    label = np.arange(len(codes))
    left, right = [], []
    for step in range(1, SMALL):
        i = np.flatnonzero((group[step:] == group[:-step]) & (home[step:] | home[:-step]))
        if not len(i):
            if not (group[step:] == group[:-step]).any():
                break
            continue
        i = i[_linked(codes[i], codes[i + step], points[i], points[i + step])]
        left.append(i)
        right.append(i + step)
    if left:
        left, right = np.concatenate(left), np.concatenate(right)
        while True:
            before = label.copy()
            np.minimum.at(label, left, label[right])
            np.minimum.at(label, right, label[left])
            if np.array_equal(label, before):
                break
    return label


def _large(codes: np.ndarray, points: np.ndarray, home: np.ndarray) -> np.ndarray:
    """The same for one group. Rows already connected are not compared again."""
    label = np.arange(len(codes))
    for i in np.flatnonzero(home).tolist():
        others = np.flatnonzero(label != label[i])
        if not len(others):
            break
        near = others[_linked(codes[i], codes[others], points[i], points[others])]
        if len(near):
            joined = np.unique(np.append(label[near], label[i]))
            label[np.isin(label, joined)] = joined[0]
    return label


def forest(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Links ``a, b`` that connect what is connected in each cell (``key, low, high``); rows come cell by cell."""
    codes = table.column("code").to_numpy()
    points = unary(codes.view(np.uint64)).view(np.uint64)
    unsigned = codes.view(np.uint64)
    home = table.column("home").combine_chunks().to_numpy(zero_copy_only=False)
    names = [table.column(c).to_numpy() for c in ("key", "low", "high")]
    group = np.concatenate(([0], np.cumsum(np.logical_or.reduce([np.diff(n) != 0 for n in names]))))
    size = np.bincount(group)[group]
    label = np.arange(len(codes))
    small = np.flatnonzero(size <= SMALL)
    label[small] = small[_small(unsigned[small], points[small], home[small], group[small])]
    for g in np.unique(group[size > SMALL]).tolist():
        own = np.arange(np.searchsorted(group, g), np.searchsorted(group, g, "right"))
        label[own] = own[_large(unsigned[own], points[own], home[own])]
    linked = np.flatnonzero((label != np.arange(len(codes))) & (codes != codes[label]))
    return codes[linked], codes[label[linked]]


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole cells: the last cell of a batch waits for the next batch."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(c).to_numpy() for c in ("key", "low", "high")]
        starts = np.flatnonzero(np.logical_or.reduce([np.diff(n) != 0 for n in names])) + 1
        new = rest and any(
            rest[-1].column(c)[rest[-1].num_rows - 1].as_py() != batch.column(c)[0].as_py() for c in ("key", "low", "high")
        )
        if new:
            yield pa.Table.from_batches(rest)
            rest = []
        if len(starts):
            yield pa.Table.from_batches([*rest, batch.slice(0, int(starts[-1]))])
            rest = [batch.slice(int(starts[-1]))]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)


def grid_links(codes: DataFrame) -> DataFrame:
    """``a, b``: links between fingerprints of ``codes`` (distinct) that connect all that are within the distance."""
    crowded = shared.store(
        cell_rows(codes).groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > BLOCK), "crowded_cells"
    )
    blocks = F.coalesce(F.ceil(F.col("size") / BLOCK).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64("code"), blocks).cast("int")
    dealt = cell_rows(codes).join(crowded, "key", "left").select("key", "code", "home", own.alias("own"), blocks.alias("n"))
    # A pair of blocks is one piece of work; two rows of one block meet in that block's own piece only.
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "code", "home"
    )
    common.ship(codes.sparkSession)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_cells(batches):
            a, b = forest(table)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    ordered = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    with common.batch_rows(codes.sparkSession, ROWS):
        return shared.store(ordered.mapInArrow(run, "a bigint, b bigint"), "grid_links")


#: Rows of the batches that cells come in.
ROWS = 1 << 15


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    listed = shared.store(fingerprinted(documents), "fingerprinted")
    codes = shared.store(listed.groupBy("code").agg(F.min("doc_id").alias("least_id")), "fingerprints")
    labels = shared.store(components(grid_links(codes)), "labels")
    of_code = shared.store(
        codes.join(labels, F.col("code") == F.col("node"), "left").select("code", "least_id", F.coalesce("label", "code").alias("label")),
        "label_of_fingerprint",
    )
    least = shared.store(of_code.groupBy("label").agg(F.min("least_id").alias("component_id")), "component_ids")
    named = shared.store(of_code.join(least, "label").select("code", "component_id"), "component_of_fingerprint")
    return listed.join(named, "code").select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
