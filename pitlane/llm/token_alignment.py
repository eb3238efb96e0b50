"""How the tokens of two tokenizers lie over each other, by Arrow kernels on token ends.

1. A batch of texts is cut at single spaces between two characters that are no
   white space. Neither tokenizer has a token over such a place, so each
   distinct segment of a batch is encoded once, many in one call, and both tokenizers end there.
2. Both token lists are flattened; parent indices tell each token's segment, a
   cumulative sum of byte lengths less its value at the segment's start gives
   the token's end. A token's key is (segment, end).
3. An inner hash join of the two sides on that key gives the places where both
   end, which close a group. A full outer join, in order of the key, gives one
   row for each stretch of bytes between neighbouring ends, hence one for each
   pair of tokens that overlap: the ids missing on one side are those of its
   next row.
4. Pairs are summed to documents. Documents per pair are counted for each batch
   (``Table.group_by``) and the partial counts merged by Spark.
5. The counts of the ``FREQUENT`` most frequent pairs, a table of bounded size,
   go to every task; the links of all other pairs meet their counts in a join.

A pair's documents are rows: rows that repeat count each. Nulls: a null text is
treated as an empty one, which has no tokens; a null ``doc_id`` is kept. A text
whose tokens do not spell it (B has no token for U+2581 itself) has none.
Repeated rows give repeated rows, an empty table an empty result. Columns other
than ``doc_id`` and ``text`` are not read. Texts are never cut short: a batch of
more bytes than ``common.BATCH_BYTES`` holds one text.
"""

from __future__ import annotations

import hashlib
import json
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitlane.llm import common
from pitlane.llm.bpe import byte_letters
from pitlane.llm.token_counts import PATTERN
from pitlane.sources import shared

#: Pairs whose counts are broadcast: 13 bytes each.
FREQUENT = 1 << 17
#: Bytes of segments encoded in one call.
CHUNK = 1 << 14
#: Rows of a batch: the larger, the fewer segments are aligned twice.
ROWS = 1024

SCHEMA = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pairs array<bigint>, times array<int>, counted boolean"
)

_CUT = re.compile(r"(?<=\S) (?=\S)")
#: All that any of the libraries takes for white space.
_WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, definition: str, model: bytes):
        file = json.loads(definition)["model"]
        vocab: dict[str, int] = file["vocab"]
        self.a = Tokenizer.from_str(definition)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        spelled = [b""] * (max(vocab.values()) + 1)
        ranks: dict[bytes, int] = {}
        for token, i in vocab.items():
            if all(c in byte_of for c in token):
                spelled[i] = bytes(byte_of[c] for c in token)
                ranks[spelled[i]] = i
            else:
                spelled[i] = token.encode()
        self.bytes_a = pa.array(spelled, pa.large_binary())
        self.size_a = len(spelled)
        # Ids that follow the order of merges can serve as ranks, which lets a faster library encode plain letters.
        made = [vocab["".join(m)] for m in file["merges"]]
        self.fast = None
        if made == sorted(made):
            used = {spelled[i]: i for i in (*made, *(vocab[c] for c in byte_of))}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=used, special_tokens={})

        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any("▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError("a piece reaches over a space, so texts cannot be cut there")
        self.bytes_b = pa.array(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)],
            pa.large_binary(),
        )
        self.size_b = len(pieces)
        self.lengths = tuple(pc.binary_length(x).to_numpy() for x in (self.bytes_a, self.bytes_b))
        self.digits = pa.array([str(i) for i in range(max(len(spelled), len(pieces)))])

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a space and ``text``, by A and by B."""
        if self.fast and common.is_latin(text):
            a = self.fast.encode_ordinary(" " + text)
        else:
            a = self.a.encode(" " + text, add_special_tokens=False).ids
        return np.array(a, np.int32), np.array(self.b.encode(text), np.int32)

    def encoded(self, segments: list[str]) -> tuple[tuple[pa.LargeListArray, pa.LargeListArray], np.ndarray]:
        """The ids of each segment after a space, by A and by B, and whether both spell it; if not, it has none."""
        counts = np.zeros((2, len(segments)), np.int64)
        ok = np.ones(len(segments), bool)
        ids: tuple[list[np.ndarray], list[np.ndarray]] = [], []
        sizes = np.fromiter((len(s.encode()) + 1 for s in segments), np.int64, len(segments))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        # Segments with white space at an edge stand alone; runs of others are encoded in one go.
        alone = np.fromiter((s != s.strip(_WHITE) or not s for s in segments), bool, len(segments))
        cut = np.flatnonzero(alone)
        stops = np.unique(np.concatenate((cut, cut + 1, np.searchsorted(ends, np.arange(0, ends[-1], CHUNK)), [0, len(segments)])))
        work = [(int(i), int(j)) for i, j in zip(stops, stops[1:])][::-1]
        while work:
            i, j = work.pop()
            both = self.ids(" ".join(segments[i:j]))
            parts = []
            wanted = (" " + " ".join(segments[i:j])).encode()
            for own, lengths, spelled in zip(both, self.lengths, (self.bytes_a, self.bytes_b), strict=True):
                at = np.cumsum(lengths[own])
                upto = np.searchsorted(at, ends[i + 1 : j + 1] - ends[i], "right")
                fits = (
                    len(at) > 0 and int(at[-1]) == len(wanted) and np.array_equal(at[upto - 1], ends[i + 1 : j + 1] - ends[i])
                    and _joined(pc.take(spelled, pa.array(own))) == wanted
                )
                parts.append(np.diff(upto, prepend=0) if fits else None)
            if parts[0] is not None and parts[1] is not None:
                for side in (0, 1):
                    counts[side, i:j] = parts[side]
                    ids[side].append(both[side])
            elif j - i > 1:
                work += [((i + j) // 2, j), (i, (i + j) // 2)]
            else:
                ok[i] = False
        lists = tuple(
            pa.LargeListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(counts[side])))), pa.array(np.concatenate([np.zeros(0, np.int32), *ids[side]]))
            )
            for side in (0, 1)
        )
        return lists, ok


def _joined(tokens: pa.Array) -> bytes:
    """The bytes of all tokens of an array made by ``take``: they lie in one buffer, in order."""
    return bytes(tokens.buffers()[2] or b"")


def segments_of(texts: pa.Array) -> pa.ListArray:
    """The segments of each text, each without the space before it; an empty text has none."""
    lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    # A piece that is empty or has white space at an edge was cut where a token may reach over.
    odd = pc.not_equal(pc.utf8_trim(flat, _WHITE), flat)
    odd = pc.or_(odd, pc.equal(pc.binary_length(flat), 0))
    again = set(parent.filter(odd).to_pylist())
    if not again:
        return lists
    rows = lists.to_pylist()
    for i in again:
        text = texts[i].as_py()
        cut = _CUT.split(" " + text) if text else []
        rows[i] = [cut[0][1:], *cut[1:]] if cut else []
    return pa.array(rows, pa.large_list(pa.large_string()))


def _ends(lists: pa.LargeListArray, lengths: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The flattened ids, and each token's key: its list's number, then where it ends in its list's bytes."""
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    total = np.concatenate(([0], pc.cumulative_sum(pa.array(lengths[flat.to_numpy()], pa.int64())).to_numpy()))
    before = pa.array(total[lists.offsets.to_numpy()[:-1]])
    end = pc.subtract(pa.array(total[1:]), pc.take(before, parent))
    return flat, pc.add(pc.shift_left(parent.cast(pa.int64()), 32), end)


class Aligned:
    """Segments with their groups and links. ``ok`` tells whether both sides spell the segment."""

    def __init__(self, both: Tokenizers, segments: list[str]):
        (a, b), self.ok = both.encoded(segments)
        self.n_a, self.n_b = (np.diff(x.offsets.to_numpy()) for x in (a, b))
        ids_a, key_a = _ends(a, both.lengths[0])
        ids_b, key_b = _ends(b, both.lengths[1])
        left, right = pa.table({"key": key_a, "a": ids_a}), pa.table({"key": key_b, "b": ids_b})
        stretches = left.join(right, "key", join_type="full outer", use_threads=False).combine_chunks()
        stretches = stretches.take(pa.array(np.argsort(stretches["key"].to_numpy(), kind="stable"))).combine_chunks()
        keys = stretches["key"].to_numpy()
        # Both sides have a token that ends here: the inner join of the two.
        cuts = keys[pc.and_(pc.is_valid(stretches["a"]), pc.is_valid(stretches["b"])).to_numpy()]
        self.n_groups = np.bincount(cuts >> 32, minlength=len(segments))
        self.n_links = np.bincount(keys >> 32, minlength=len(segments))
        self.link_at = np.concatenate(([0], np.cumsum(self.n_links)))
        of_a = pc.fill_null_backward(stretches["a"]).to_numpy().astype(np.int64)
        of_b = pc.fill_null_backward(stretches["b"]).to_numpy().astype(np.int64)
        self.pairs = of_a * both.size_b + of_b
        self.groups = self._written(both, cuts, (ids_a, key_a), (ids_b, key_b))

    def _written(self, both: Tokenizers, cuts: np.ndarray, a: tuple, b: tuple) -> pa.Array:
        """Each segment's groups as ``a1,a2|b1;a3|b2``."""
        (ids_a, key_a), (ids_b, key_b) = a, b
        of_a, of_b = (np.searchsorted(cuts, k.to_numpy()) for k in (key_a, key_b))
        n_a, n_b = (np.bincount(g, minlength=len(cuts)) for g in (of_a, of_b))
        # In a group A's tokens come first; before it all tokens of earlier groups.
        at_a = np.arange(len(of_a)) + np.concatenate(([0], np.cumsum(n_b)))[of_a]
        at_b = np.arange(len(of_b)) + np.cumsum(n_a)[of_b]
        ids = np.empty(len(of_a) + len(of_b), np.int32)
        side, segment = np.empty(len(ids), np.int8), np.empty(len(ids), np.int64)
        for at, i, k, s in ((at_a, ids_a, key_a, 0), (at_b, ids_b, key_b, 1)):
            ids[at], side[at], segment[at] = i.to_numpy(), s, k.to_numpy() >> 32
        mark = np.full(len(ids), 3, np.int8)
        if len(ids):
            mark[1:] = np.where(side[1:] == side[:-1], 0, np.where(side[1:] > 0, 1, 2))
            mark[np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))] = 3
        signs = pc.take(pa.array([",", "|", ";", ""]), pa.array(mark))
        tokens = pc.binary_join_element_wise(signs, pc.take(both.digits, pa.array(ids)), "")
        offsets = np.concatenate(([0], np.cumsum(self.n_a + self.n_b))).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), tokens), "")


def _within(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[offsets[1:]] - total[offsets[:-1]]


def aligned_batch(both: Tokenizers, texts: pa.Array) -> dict[str, list | pa.Array | np.ndarray]:
    """The columns of ``SCHEMA`` that belong to texts, and ``seen``: pairs with their number of texts."""
    lists = segments_of(texts.fill_null(""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    coded = pc.dictionary_encode(pc.list_flatten(lists))
    codes = coded.indices.to_numpy().astype(np.int64)
    found = Aligned(both, coded.dictionary.to_pylist())
    filled = np.diff(offsets) > 0
    valid = filled & (_within((~found.ok[codes]).astype(np.int64), offsets) == 0)
    # "" splits into one empty segment, which has no tokens by rule.
    valid &= ~np.asarray(pc.equal(pc.binary_length(texts.fill_null("")), 0).to_numpy(zero_copy_only=False), bool)
    out = {name: _within(getattr(found, name)[codes], offsets) * valid for name in ("n_a", "n_b", "n_groups", "n_links")}
    of_segments = pc.take(found.groups.cast(pa.large_string()), pa.array(codes))
    written = pc.binary_join(
        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), of_segments), pa.scalar(";", pa.large_string())
    )
    out["groups_sha256"] = [
        hashlib.sha256(t.as_buffer()).hexdigest() if v else "" for t, v in zip(written, valid.tolist(), strict=True)
    ]

    # Distinct (text, segment) with its times, then its links, then sums over (text, pair).
    text = np.repeat(np.arange(len(valid)), np.diff(offsets))
    held = valid[text]
    segment, times = np.unique(text[held] * len(coded.dictionary) + codes[held], return_counts=True)
    text, code = np.divmod(segment, max(1, len(coded.dictionary)))
    n = found.n_links[code]
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(found.link_at[code], n)
    links = pa.table({"text": np.repeat(text, n), "pair": found.pairs[place], "times": np.repeat(times, n).astype(np.int32)})
    summed = links.group_by(["text", "pair"], use_threads=False).aggregate([("times", "sum")])
    summed = summed.sort_by([("text", "ascending"), ("pair", "ascending")]).combine_chunks()
    at = pa.array(np.searchsorted(summed["text"].to_numpy(), np.arange(len(valid) + 1)).astype(np.int32))
    pairs, times = (summed[c].combine_chunks() for c in ("pair", "times_sum"))
    out["pairs"] = pa.ListArray.from_arrays(at, pairs)
    out["times"] = pa.ListArray.from_arrays(at, times.cast(pa.int32()))
    out["seen"] = summed.group_by("pair", use_threads=False).aggregate([("pair", "count")])
    return out


_WORKER: dict[int, Tokenizers] = {}


def _of_worker(definition: str, model: bytes) -> Tokenizers:
    key = hash((definition, model))
    if key not in _WORKER:
        _WORKER[key] = Tokenizers(definition, model)
    return _WORKER[key]


def links(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of ``SCHEMA``: one per document, and those with ``counted``, which hold the documents per pair of a batch.

    ``row`` numbers the documents; ``pairs`` are the pairs a document holds, as id of A times B's size plus id of B,
    with how often each is linked (``times``).
    """
    spark = documents.sparkSession
    files = spark.sparkContext.broadcast((Path(path_a).read_text(encoding="utf-8"), Path(path_b).read_bytes()))

    def start() -> common.Work:
        both = _of_worker(*files.value)

        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            out = aligned_batch(both, batch.column("text"))
            seen = out.pop("seen")
            columns = {"row": batch.column("row"), "doc_id": batch.column("doc_id")} | out
            columns = {name: list(c) if isinstance(c, np.ndarray) else c for name, c in columns.items()}
            extra = {"pairs": seen["pair"].combine_chunks(), "times": seen["pair_count"].combine_chunks().cast(pa.int32())}
            columns["counted"] = [False] * batch.num_rows + [True]
            for name in ("row", "doc_id"):
                columns[name] = pa.concat_arrays([columns[name], pa.nulls(1, columns[name].type)])
            for name in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"):
                columns[name] = [*columns[name], None]
            for name, values in extra.items():
                one = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                columns[name] = pa.concat_arrays([columns[name], one])
            return columns

        return work

    numbered = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )
    return common.map_batches(numbered, SCHEMA, start, rows=ROWS)


def pair_counts(linked: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: in how many documents a pair is linked, and whether no pair of its A id is in more."""
    partial = linked.filter("counted").select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        F.col("p.pairs").alias("pair"), F.col("p.times").alias("n")
    )
    counts = partial.groupBy("pair").agg(F.sum("n").alias("n"))
    # An A id has no more partners than B has ids.
    of_a = Window.partitionBy(F.expr(f"pair div {size_b}"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def scored(linked: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    spark = linked.sparkSession
    top = counts.orderBy(F.desc("n"), "pair").limit(frequent).toPandas().sort_values("pair")
    known = spark.sparkContext.broadcast((
        top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool),
    ))

    def start() -> common.Work:
        pair, n, best = known.value

        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            pairs, times = batch.column("pairs"), batch.column("times")
            at = pairs.offsets.to_numpy().astype(np.int64)
            at = at - at[0]
            flat, often = pc.list_flatten(pairs).to_numpy(), pc.list_flatten(times).to_numpy().astype(np.int64)
            place = np.minimum(np.searchsorted(pair, flat), max(0, len(pair) - 1))
            hit = pair[place] == flat if len(pair) else np.zeros(len(flat), bool)
            n_hit = n[place] * hit if len(pair) else np.zeros(len(flat), np.int64)
            best_hit = best[place] & hit if len(pair) else hit
            rest = np.concatenate(([0], np.cumsum(~hit)))[at].astype(np.int32)
            return {
                "row": batch.column("row"), "n_best": list(_within(often * best_hit, at)),
                "count_sum": list(_within(often * n_hit, at)),
                "pairs": pa.ListArray.from_arrays(pa.array(rest), pa.array(flat[~hit])),
                "times": pa.ListArray.from_arrays(pa.array(rest), pa.array(often[~hit].astype(np.int32))),
            }

        return work

    documents = linked.filter(~F.col("counted"))
    looked_up = shared.store(
        common.map_batches(
            documents.select("row", "pairs", "times"),
            "row bigint, n_best bigint, count_sum bigint, pairs array<bigint>, times array<int>", start,
        ),
        "frequent_links",
    )
    rare = looked_up.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")
    )
    more = rare.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("bigint").alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    total = looked_up.select("row", "n_best", "count_sum").join(more, "row", "left").select(
        "row", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )
    return documents.drop("pairs", "times", "counted").join(total, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def alignment(documents: DataFrame, path_a: str, path_b: str, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size()
    linked = shared.store(links(documents, path_a, path_b), "token_links")
    counts = shared.store(pair_counts(linked, size_b), "pair_counts")
    return scored(linked, counts, frequent)
