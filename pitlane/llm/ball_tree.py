"""Ranked lexical search: exact inner-product search in sparse ball trees.

A document is a sparse vector over the items' terms, an entry being what the
term adds to an item's score, in whole numbers; an item is the set of its terms.

1. One pass over the texts stores each document's term counts for the terms that
   items have, with its length. Document frequencies, the number of documents
   and their total length come from that table.
2. Each task takes up to ``TREE`` documents at a time and splits them by the
   nearer of two distant documents, down to leaves of ``LEAF``. A node keeps its
   documents' mean, and the greatest distance from it in each group of terms.
3. No document of a node scores more than its mean does plus, for each group,
   radius times the root of the number of the item's terms in it (Cauchy-Schwarz
   by group: one group is the common ball bound, more are tighter; terms have a
   group each, up to ``GROUPS``). Nodes are visited by that
   bound, the highest first, until it is below the item's ``k``-th best score so
   far, which a task carries from tree to tree. Bounds are raised by more than
   the rounding of what they are made of, so no document is lost to it; equal
   bounds are visited, as equal scores are ranked by ``doc_id``.
4. Leaves are scored in 64-bit integers. Each task gives ``k`` documents an item
   at most; a window ranks them.

Items are taken in blocks of ``ITEM_BYTES`` of text, each against all documents.
Nulls: a null text has no terms and counts nowhere; a null ``doc_id`` ranks
after others of its score. An item is a distinct (``item_id``, ``text``);
repeated documents each take a rank. Empty tables give empty results. Other
columns are not read; texts are read whole.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from pitlane.llm import common
from pitlane.sources import shared

#: Documents of an item that are returned.
K = 50
#: Documents of a tree and of a leaf.
TREE, LEAF = 4096, 32
#: Groups of terms with a radius of their own.
GROUPS = 16_384
#: About so many bytes of item texts are searched for in one pass.
ITEM_BYTES = 1 << 18

#: Letters and digits of ASCII and all bytes of other characters stay, A to Z in lower case; the rest parts terms.
_KEPT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_KEPT).split()


class Items:
    """A block of items: their ids, and each one's terms as numbers."""

    def __init__(self, rows: list[Row]):
        self.number: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.terms: list[np.ndarray] = []
        for row in rows:
            numbers = [self.number.setdefault(t, len(self.number)) for t in dict.fromkeys(terms_of(row.text))]
            self.ids.append(row.item_id)
            self.terms.append(np.array(numbers, np.int64))


def vectors(documents: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs``: a document's length in terms, and how often it has which of the numbered terms."""
    known = documents.sparkSession.sparkContext.broadcast(number)

    def start() -> common.Work:
        get = known.value.get

        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            lengths, terms, tfs = [], [], []
            for text in batch.column("text").to_pylist():
                words = terms_of(text)
                found = Counter(map(get, words))
                found.pop(None, None)
                lengths.append(len(words))
                terms.append(list(found))
                tfs.append(list(found.values()))
            return {"doc_id": batch.column("doc_id"), "n": lengths, "terms": terms, "tfs": tfs}

        return work

    read = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return common.map_batches(read, "doc_id bigint, n bigint, terms array<int>, tfs array<int>", start)


def weights_of(stored: DataFrame, n_terms: int) -> tuple[np.ndarray, int, int]:
    """The weight of each numbered term, the number of documents with a term, and their total length."""
    n_docs, length = stored.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    frequency = np.zeros(n_terms, np.int64)
    counted = stored.select(F.explode("terms").alias("term")).groupBy("term").count()
    for row in counted.collect():  # A row for each term of the block.
        frequency[row.term] = row["count"]
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in frequency.tolist()]
    return np.array(weights, np.int64), n_docs, length or 0


class Tree:
    """Sparse rows in the order of a ball tree. ``values`` are whole numbers, and all rows have entries.

    ``group`` gives the group of each column; a node has a radius in each group's subspace.
    """

    def __init__(self, at: np.ndarray, columns: np.ndarray, values: np.ndarray, group: np.ndarray):
        self.width, self.group, self.n_groups = len(group), group, int(group.max(initial=-1)) + 1
        self.order = np.arange(len(at) - 1)
        #: A node: first row, row after the last, number of its first child or 0 for a leaf.
        self.nodes = [[0, len(at) - 1, 0]]
        for node in self.nodes:
            low, high, _ = node
            if high - low > LEAF:
                rows = self.order[low:high]
                half = (high - low) // 2
                self.order[low:high] = rows[np.argpartition(_side(*_taken(at, columns, values, rows), self.width), half)]
                node[2] = len(self.nodes)
                self.nodes += [[low, low + half, 0], [low + half, high, 0]]
        self.at, self.columns, self.values = _taken(at, columns, values, self.order)
        self.centre = np.zeros((len(self.nodes), self.width))
        self.radius = np.zeros((len(self.nodes), self.n_groups))
        for number in range(len(self.nodes) - 1, -1, -1):
            low, high, child = self.nodes[number]
            if not child:
                self.centre[number], self.radius[number] = self._ball(low, high)
                continue
            # A mean of means; a child's ball lies in the parent's, by the triangle inequality.
            sizes = np.array([n[1] - n[0] for n in self.nodes[child : child + 2]])
            self.centre[number] = sizes @ self.centre[child : child + 2] / sizes.sum()
            apart = self._rooted((self.centre[child : child + 2] - self.centre[number]) ** 2)
            self.radius[number] = ((apart + self.radius[child : child + 2]) * (1 + 2.0**-40)).max(0)

    def _rooted(self, squares: np.ndarray) -> np.ndarray:
        """Lengths by group, from squares by column; not below the true ones."""
        sums = np.stack([np.bincount(self.group, row, minlength=self.n_groups) for row in squares])
        return np.sqrt(sums * (1 + 2.0**-30))

    def _ball(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.at[low], self.at[high])
        columns, real = self.columns[part], self.values[part].astype(np.float64)
        centre = np.bincount(columns, real, minlength=self.width) / (high - low)
        row = np.repeat(np.arange(high - low), np.diff(self.at[low : high + 1]))
        # What a row's entries change in the squared length of the mean, summed by row and group.
        change = (real - centre[columns]) ** 2 - centre[columns] ** 2
        scale = (real + centre[columns]) ** 2
        at = row * self.n_groups + self.group[columns]
        size = (high - low) * self.n_groups
        base = np.bincount(self.group, centre**2, minlength=self.n_groups)
        square = np.bincount(at, change, minlength=size).reshape(-1, self.n_groups) + base
        lost = (np.bincount(at, scale, minlength=size).reshape(-1, self.n_groups) + base) * 2.0**-30
        return centre, np.sqrt(np.maximum(square, 0) + lost).max(0)

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        """No row of a node scores more. The shares added exceed what rounding can take off such sums."""
        n = np.bincount(self.group[terms], minlength=self.n_groups)
        groups = np.flatnonzero(n)
        return (self.centre[:, terms].sum(1) + self.radius[:, groups] @ np.sqrt(n[groups])) * (1 + 2.0**-30) + 1

    def scores(self, node: list[int], wanted: np.ndarray) -> np.ndarray:
        """Exact scores of a node's rows; ``wanted`` is 1 at the item's terms and 0 elsewhere."""
        low, high, _ = node
        part = slice(self.at[low], self.at[high])
        return np.add.reduceat(self.values[part] * wanted[self.columns[part]], self.at[low:high] - self.at[low])

    def best_first(self, terms: np.ndarray, least: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and scores of the leaves that may hold one of the ``k`` highest scores, given that ``least`` is reached."""
        bounds = self.bounds(terms).tolist()
        wanted = np.zeros(self.width, np.int64)
        wanted[terms] = 1
        waiting = [(-bounds[0], 0)]
        held = np.zeros(0, np.int64)
        while waiting:
            bound, number = heapq.heappop(waiting)
            if -bound < least:
                return
            node = self.nodes[number]
            if node[2]:
                for child in (node[2], node[2] + 1):
                    if bounds[child] >= least:
                        heapq.heappush(waiting, (-bounds[child], child))
                continue
            scores = self.scores(node, wanted)
            held = np.sort(np.concatenate((held, scores)))[-k:]
            if len(held) == k:
                least = max(least, int(held[0]))
            yield self.order[node[0] : node[1]], scores


def _taken(at: np.ndarray, columns: np.ndarray, values: np.ndarray, rows: np.ndarray) -> tuple:
    n = at[rows + 1] - at[rows]
    new = np.concatenate(([0], np.cumsum(n)))
    place = np.arange(new[-1]) - np.repeat(new[:-1], n) + np.repeat(at[rows], n)
    return new, columns[place], values[place]


def _side(at: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """Rows in order from one of two distant rows to the other."""
    real = values.astype(np.float64)
    own = np.add.reduceat(real * real, at[:-1])

    def squares(point: np.ndarray) -> np.ndarray:
        return own - 2 * np.add.reduceat(real * point[columns], at[:-1])

    def dense(row: int) -> np.ndarray:
        out = np.zeros(width)
        out[columns[at[row] : at[row + 1]]] = real[at[row] : at[row + 1]]
        return out

    one = dense(int(squares(np.bincount(columns, real, minlength=width) / len(own)).argmax()))
    to_one = squares(one)
    return to_one - squares(dense(int(to_one.argmax())))


def searched(stored: DataFrame, items: Items, k: int = K) -> DataFrame:
    """``item, doc_id, score``: each task's ``k`` best documents of each item, and more where scores are equal."""
    weights, n_docs, length = weights_of(stored, len(items.number))
    spark = stored.sparkSession
    given = spark.sparkContext.broadcast((items.terms, weights))
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of_item, weight = given.value
        wanted = [t[weight[t] > 0] for t in terms_of_item]
        rank = np.argsort(np.argsort(weight, kind="stable"))
        group = rank if len(rank) <= GROUPS else rank * GROUPS // len(rank)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2 for _ in wanted]
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column("terms").offsets.to_numpy().astype(np.int64)
            columns = batch.column("terms").flatten().to_numpy()
            tf = batch.column("tfs").flatten().to_numpy().astype(np.int64)
            m = 100 - 50 + 50 * batch.column("n").to_numpy() * n_docs // length
            values = weight[columns] * (1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, np.diff(at))))
            # Ids as numbers that sort a null last.
            ids = batch.column("doc_id").fill_null(_LAST).to_numpy()
            tree = Tree(at - at[0], columns, values, group)
            for i, terms in enumerate(wanted):
                if not len(terms):
                    continue
                scores, found = best[i]
                least = int(scores[-1]) if len(scores) >= k else 1
                new = [(s, ids[rows]) for rows, s in tree.best_first(terms, least, k)]
                scores = np.concatenate([scores, *(s for s, _ in new)])
                found = np.concatenate([found, *(d for _, d in new)])
                first = np.lexsort((found, -scores))[:k]
                first = first[scores[first] > 0]
                best[i] = scores[first], found[first]
        for i, (scores, found) in enumerate(best):
            if len(scores):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(scores), i, np.int32)), pa.array(found, mask=found == _LAST), pa.array(scores),
                ], schema=schema)

    common.ship(spark)
    held = stored.filter(F.size("terms") > 0)
    with common.batch_rows(spark, TREE):
        return shared.store(held.mapInArrow(run, "item int, doc_id bigint, score bigint"), "best_of_task")


_LAST = np.iinfo(np.int64).max


def _blocks(items: DataFrame, size: int) -> Iterator[list[Row]]:
    """The distinct items in blocks of about ``size`` bytes of text."""
    items = shared.store(items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct(), "items")
    n = math.ceil((items.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0) / size)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, n)))
    for i in range(n):
        yield items.filter(block == i).sort("item_id", "text").collect()


def ranked(documents: DataFrame, items: DataFrame, k: int = K, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` highest-scoring documents with a score above 0."""
    spark = documents.sparkSession
    found = []
    for rows in _blocks(items, item_bytes):
        block = Items(rows)
        stored = shared.store(vectors(documents, block.number), "term_vectors")
        names = spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id bigint")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = searched(stored, block, k).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        found.append(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionAll, found)


SQL = """
with
docs as (
    select row_number() over () as rid, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
    from documents
),
entries as (select rid, unnest(terms) as term from docs),
counts as (select rid, term, count(*) as tf from entries group by all),
frequencies as (select term, count(*) as df from counts group by term),
lengths as (select rid, count(*) as n from entries group by rid),
totals as (select count(*)::hugeint as n_docs, sum(n)::hugeint as length from lengths),
items as (
    select distinct item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from benchmark
),
scores as (
    select item_id, rid, sum(
        floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)))::bigint
        * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // length)))
    )::bigint as score
    from items join frequencies using (term) join counts using (term) join lengths using (rid) cross join totals
    group by item_id, rid
),
ranked as (
    select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
    from scores join docs using (rid) where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""
