"""Near-duplicates by b-bit minwise signatures and a multi-index Hamming join.

1. Documents of equal shingle sets form a class; one signature per class.
2. A signature of ``POSITIONS`` numbers of 16 bits is split into ``CHUNKS``
   chunks. Two signatures that differ in at most ``DISTANCE`` positions have,
   by the pigeonhole principle, a chunk that differs in at most one position.
   All patterns of one error are enumerated: a chunk gives one key for each of
   its positions left out. So each such pair meets in a bucket.
3. In each bucket every class is compared with its most central one, which is
   the one that meets most others over all its buckets; links that hold on full
   shingle sets are joined to components.
4. Buckets whose members are still in several components are compared inside,
   pairs of one component left out. Large buckets are dealt out in blocks of
   ``BLOCK`` rows, each pair of blocks being one piece of work. A first pass
   keeps the rows that have a candidate in their piece: within ``DISTANCE``,
   close in a longer signature, and in no bucket together before. Their full
   sets are then compared where they lie, and a piece gives no more links than
   connect its components. So every such pair is linked, refused on its full
   sets, or in one component without it.
5. Components are labelled with the least ``doc_id`` in them.

A pair at the similarity of 0.75 differs in 12 positions on average; more than
``DISTANCE`` of 48 has odds of about 1 in 7,000, and far less above 0.75.

Rows are what is linked, not ids: of one id on two texts each is linked by its
own text, and the component of either holds both only if the texts are linked.
Nulls and empty texts have an empty set and are linked with nothing. Documents
without ``doc_id`` are linked with nothing, have no component and are kept, but
for copies of another row (``without_near_duplicates``).
Repeated rows get equal results. Other columns are not read. An empty table
gives an empty result. Very long texts are hashed as whole arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from pitlane.llm import common
from pitlane.llm.components import components
from pitlane.llm.shingles import (
    FINE, FINE_EQUAL, POSITIONS, byte_texts, class_of, fine_signature, shingle_set, signature, similar,
)
from pitlane.sources import shared

#: Chunks of a signature, positions of a chunk, and the greatest distance that is guaranteed.
CHUNKS = 12
WIDTH = POSITIONS // CHUNKS
DISTANCE = 2 * CHUNKS - 1
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = pow(int(_FACTOR), -1, 1 << 64)
#: Rows of a block; two blocks are compared in one piece.
BLOCK = 1024


def classified(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_shingles, class, signature``; class and signature are null for empty sets."""

    def start() -> common.Work:
        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            sets = [shingle_set(t) for t in byte_texts(batch.column("text"))]
            return {
                "doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"),
                "n_shingles": [len(s) for s in sets],
                "class": [class_of(s) if len(s) else None for s in sets],
                "signature": [signature(s).tobytes() if len(s) else None for s in sets],
            }

        return work

    read = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    return common.map_batches(
        read, "doc_id bigint, text_key bigint, n_shingles bigint, class bigint, signature binary", start
    )


def bucket_keys(classes: DataFrame) -> DataFrame:
    """``key`` and the columns of ``classes``: ``POSITIONS`` rows for each, one for each chunk and place of the allowed error."""

    def start() -> common.Work:
        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            known = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16)
            chunks = known.reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
            keys = []
            for left_out in range(WIDTH):
                rest = [i for i in range(WIDTH) if i != left_out]
                packed = chunks[:, :, rest[0]]
                for i in rest[1:]:
                    packed = (packed << np.uint64(16)) | chunks[:, :, i]
                place = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(left_out)
                with np.errstate(over="ignore"):
                    # 48 bits of values and 6 of the place: one to one, then spread by an odd factor.
                    keys.append(((packed << np.uint64(6)) | place) * _FACTOR)
            return {
                **{c: batch.column(c) for c in batch.schema.names},
                "key": pa.FixedSizeListArray.from_arrays(pa.array(np.stack(keys, 2).reshape(-1).view(np.int64)), POSITIONS),
            }

        return work

    listed = common.map_batches(classes, StructType([*classes.schema, StructField("key", ArrayType(LongType()))]), start)
    return listed.withColumn("key", F.explode("key"))


def place_of(key: int) -> int:
    """The chunk and the place left out that a key was made of."""
    return key * _INVERSE & 63


def first_places(equal: np.ndarray) -> np.ndarray:
    """The first place whose key two signatures share, from their equal positions; -1 if there is none."""
    chunks = equal.reshape(-1, CHUNKS, WIDTH)
    shared_chunk = chunks.sum(2) >= WIDTH - 1
    chunk = shared_chunk.argmax(1)
    # Of a chunk equal throughout, the first key leaves out place 0; else the key leaves out what differs.
    left_out = (~chunks[np.arange(len(chunks)), chunk]).argmax(1)
    return np.where(shared_chunk.any(1), chunk * WIDTH + left_out, -1)


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.count_nonzero(a != b, axis=-1) <= DISTANCE


def near_leaders(buckets: DataFrame, leaders: DataFrame) -> DataFrame:
    """``a, b``: members of ``buckets`` (``key, class, signature``) that are within the distance of their bucket's leader."""
    both = buckets.join(leaders.select("key", "leader", F.col("signature").alias("of_leader")), "key").filter("class <> leader")

    def start() -> common.Work:
        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            of = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, POSITIONS)
                for c in ("signature", "of_leader")
            ]
            near = _close(*of)
            one, other = (batch.column(c).to_numpy()[near] for c in ("class", "leader"))
            return {"a": pa.array(np.minimum(one, other)), "b": pa.array(np.maximum(one, other))}

        return work

    read = both.select("class", "leader", "signature", "of_leader")
    return common.map_batches(read, "a bigint, b bigint", start, rows=4096).distinct()


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose full shingle sets are similar enough; ``sets`` has ``class, shingles``."""
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")

    def start() -> common.Work:
        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            a, b = ([np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(c)] for c in ("set_a", "set_b"))
            holds = pa.array([similar(x, y) for x, y in zip(a, b, strict=True)], pa.bool_())
            return {name: batch.column(name).filter(holds) for name in ("a", "b")}

        return work

    return common.map_batches(both.select("a", "b", "set_a", "set_b"), "a bigint, b bigint", start)


def class_sets(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """``class, shingles, fine`` of ``classes`` (``class, least_id``): the set of the document that stands for a class."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("least_id"), "text").filter(F.col("text").isNotNull())
    found = texts.join(classes.select("class", "least_id"), "least_id")

    def start() -> common.Work:
        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            sets = [shingle_set(t) for t in byte_texts(batch.column("text"))]
            # Ids may repeat with other texts: the set decides.
            given = zip(batch.column("class").to_pylist(), sets, strict=True)
            same = [len(s) > 0 and class_of(s) == c for c, s in given]
            kept = [s for s, holds in zip(sets, same, strict=True) if holds]
            return {
                "class": batch.column("class").filter(pa.array(same, pa.bool_())), "shingles": [s.tobytes() for s in kept],
                "fine": [fine_signature(s).tobytes() for s in kept],
            }

        return work

    sets = common.map_batches(found.select("class", "text"), "class bigint, shingles binary, fine binary", start)
    return sets.dropDuplicates(["class"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one ``key, low, high`` after another; they come sorted."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(c).to_numpy() for c in ("key", "low", "high")]
        starts = np.flatnonzero(np.logical_or.reduce([np.diff(n) != 0 for n in names])) + 1
        if rest and any(
            rest[-1].column(c)[rest[-1].num_rows - 1].as_py() != batch.column(c)[0].as_py() for c in ("key", "low", "high")
        ):
            yield pa.Table.from_batches(rest)
            rest = []
        at = 0
        for s in starts.tolist():
            yield pa.Table.from_batches([*rest, batch.slice(at, s - at)])
            rest, at = [], s
        rest.append(batch.slice(at))
    if rest:
        yield pa.Table.from_batches(rest)


_MEMBER = "key bigint, low int, high int, own int, class bigint, label bigint, signature binary, fine binary"


def dealt(members: DataFrame) -> DataFrame:
    """``members`` (``key, size, class, label, signature, fine``) in pieces of work ``key, low, high``.

    A bucket of more than ``BLOCK`` rows is dealt out by a hash of the class;
    each pair of its blocks is one piece, so a task holds two blocks at most.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("class"), blocks).cast("int")
    return members.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    ).select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "class", "label",
        "signature", "fine",
    )


def _candidates(group: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of a piece of work, and those later in it that they may be similar to and do not share a label with.

    Such a pair is within ``DISTANCE``, close in the longer signature, and shares no earlier bucket.
    """
    ids, labels, own = (group.column(c).to_numpy() for c in ("class", "label", "own"))
    known = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint16).reshape(-1, POSITIONS)
    fine = np.frombuffer(b"".join(group.column("fine").to_pylist()), np.uint8).reshape(-1, FINE)
    low, high, place = group.column("low")[0].as_py(), group.column("high")[0].as_py(), place_of(group.column("key")[0].as_py())
    right = np.flatnonzero(own == high)
    for i in np.flatnonzero(own == low).tolist():
        others = right[(labels[right] != labels[i]) & ((low != high) | (ids[right] > ids[i]))]
        equal = known[others] == known[i]
        others = others[(first_places(equal) == place) & (equal.sum(1) >= POSITIONS - DISTANCE)]
        alike = (fine[others] == fine[i]).sum(1)
        others = others[alike >= FINE_EQUAL][np.argsort(-alike[alike >= FINE_EQUAL], kind="stable")]
        if len(others):
            yield i, others


def involved(members: DataFrame) -> DataFrame:
    """The rows of ``dealt`` that have any candidate in their piece of work: never more than there are."""
    common.small_batches(members.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            hit = np.zeros(group.num_rows, bool)
            for i, others in _candidates(group):
                hit[i] = hit[others] = True
            if hit.any():
                yield from group.filter(pa.array(hit)).combine_chunks().to_batches()

    ordered = dealt(members).repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return ordered.mapInArrow(run, _MEMBER)


def links_inside(rows: DataFrame) -> DataFrame:
    """``a, b``: labels that a link holds together, from ``involved`` rows with their ``shingles``.

    Candidates are compared on full sets, the likeliest first, but for those
    whose labels are connected in the piece already. What is left is a forest
    over the piece's labels.
    """
    common.small_batches(rows.sparkSession)
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            labels = group.column("label").to_pylist()
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in group.column("shingles")]
            root = {label: label for label in labels}

            def top(label: int, root: dict[int, int] = root) -> int:
                while root[label] != label:
                    root[label] = label = root[root[label]]
                return label

            found = []
            for i, others in _candidates(group):
                for j in others.tolist():
                    one, other = top(labels[i]), top(labels[j])
                    if one != other and similar(sets[i], sets[j]):
                        root[one] = other
                        found.append((labels[i], labels[j]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], schema=arrow)

    ordered = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return ordered.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    return decided(documents).drop("text_key", "class", "label")


def decided(documents: DataFrame) -> DataFrame:
    """``near_duplicates`` with ``text_key``, ``class`` and ``label``.

    ``text_key`` is ``xxhash64`` of the text and tells rows of one id apart; ``label`` is the component of the class,
    null if no row of the class has an id.
    """
    listed = shared.store(classified(documents), "classified")
    classes = shared.store(
        listed.filter(F.col("class").isNotNull() & F.col("doc_id").isNotNull()).groupBy("class").agg(
            F.min("doc_id").alias("least_id"), F.min("signature").alias("signature")
        ),
        "classes",
    )
    keys = bucket_keys(classes.select("class", "signature")).select("key", "class")
    sizes = shared.store(keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "bucket_sizes")
    # Classes that meet any other, and how often: from here on only these are handled.
    met = shared.store(keys.join(sizes, "key").groupBy("class").agg(F.sum("size").alias("met")), "met")
    central = classes.join(met, "class")
    sets = shared.store(class_sets(documents, central), "sets")
    buckets = shared.store(bucket_keys(central.select("class", "signature", "met")).join(sizes, "key"), "buckets")
    leaders = shared.store(
        buckets.groupBy("key").agg(F.max(F.struct("met", "class", "signature")).alias("l"))
        .select("key", F.col("l.class").alias("leader"), "l.signature"),
        "leaders",
    )

    # Every member of a bucket with its central one.
    first = shared.store(near_leaders(buckets, leaders), "first_pairs")
    edges = shared.store(linked(first, sets.select("class", "shingles")), "first_links")
    labels = shared.store(components(edges), "first_labels")

    # What is still apart inside a bucket.
    labelled = buckets.filter("size > 2").join(labels, F.col("class") == F.col("node"), "left").select(
        "key", "size", "class", "signature", F.coalesce("label", "class").alias("label")
    )
    labelled = shared.store(labelled, "labelled")
    apart = shared.store(
        labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
        .select("key"),
        "apart",
    )
    members = labelled.join(apart, "key").join(sets.select("class", "fine"), "class")
    candidates = shared.store(involved(members), "candidates")
    # Links between components of the first round, each of which is one node now.
    between = links_inside(candidates.join(sets.select("class", "shingles"), "class"))
    merged = shared.store(components(between).toDF("first", "last"), "merged_labels")

    of_class = classes.join(labels, F.col("class") == F.col("node"), "left").select(
        "class", "least_id", F.coalesce("label", "class").alias("first")
    )
    of_class = shared.store(
        of_class.join(merged, "first", "left").select("class", "least_id", F.coalesce("last", "first").alias("label")),
        "label_of_class",
    )
    # Stored on their own: a join on the key of an aggregate could not be split where one component holds most classes.
    least = shared.store(of_class.groupBy("label").agg(F.min("least_id").alias("of_component")), "component_ids")
    named = shared.store(of_class.join(least, "label").select("class", "label", "of_component"), "component_of_class")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("of_component", "doc_id"))
    return listed.join(named, "class", "left").select(
        "doc_id", "text_key", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "class", "label",
    )


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """One row of each component, with all its columns; rows of empty sets are kept.

    Rows repeated with one id, near copies that share an id, and rows without
    id whose shingle set another row has, count as copies too. A class without
    any id is a component of its own. Keys of rows are aggregated before they are
    dealt out, and only rows of a repeated key move with their texts.
    """
    keys = shared.store(
        decided(documents).filter(F.col("class").isNotNull()).groupBy(
            F.coalesce("label", "class").alias("component"), "doc_id", "text_key"
        ).agg(F.count("*").alias("n")),
        "component_keys",
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    chosen = shared.store(keys.groupBy("component").agg(F.min(order).alias("first")), "component_first")
    found_id, found_key, own_id, own_key = common.fresh(documents, "_id", "_key", "_own_id", "_own_key")
    judged = keys.join(chosen, "component").select(
        F.col("doc_id").alias(found_id), F.col("text_key").alias(found_key), "n", (order == F.col("first")).alias("first")
    )
    judged = shared.store(judged.filter(~F.col("first") | (F.col("n") > 1)), "component_rows")
    match = F.col("doc_id").cast("bigint").eqNullSafe(F.col(found_id)) & (F.xxhash64("text") == F.col(found_key))
    apart = documents.join(judged.select(found_id, found_key), match, "left_anti")
    own = {own_id: F.col("doc_id").cast("bigint"), own_key: F.xxhash64("text")}
    repeated = documents.join(judged.filter("first").select(found_id, found_key), match, "left_semi").withColumns(own)
    return apart.unionByName(repeated.dropDuplicates([*own]).drop(*own))


SQL = """
with recursive
words as (
    select row_number() over () as rid, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'
    ), lambda x: x <> '') as ws from documents
),
sets as (
    select rid, doc_id, unnest(case
        when len(ws) >= 5 then list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
        when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s
    from words
),
sizes as (select rid, doc_id, count(*) as n from sets group by all),
shared as (
    select a.rid as x, b.rid as y, count(*) as n_both from sets a join sets b on a.s = b.s and a.rid <> b.rid group by all
),
links as (
    select x, y from shared join sizes p on p.rid = x join sizes q on q.rid = y
    where 100 * n_both >= 75 * (p.n + q.n - n_both)
),
reached as (
    select rid as x, rid as y from words
    union
    select reached.x, links.y from reached join links on links.x = reached.y
),
least as (select x, min(doc_id) as component_id from reached join words on rid = y group by x)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from words left join sizes using (rid, doc_id) join least on x = rid
"""
