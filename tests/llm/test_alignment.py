"""Token alignment against the two libraries and plain loops."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF_DIR
from pitlane.llm import token_alignment
from pitlane.llm.common import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", " ", " ", "  ", "\n", "a", "b", "the", " word", "\t", "é", "'s", ".", "12", "\x1f", "﻿", "\xa0", "　", "語", "🎉",
         "▁", "<s>", "<|endoftext|>", "<0x0A>", "\x00", "\x85", "É"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), token_alignment.Tokenizers(Path(A).read_text(), Path(B).read_bytes())


def plainly(libraries, text: str | None) -> tuple | None:
    """Groups and links of a text, by loops; None if it has no tokens."""
    a, b, both = libraries
    if not text:
        return None
    of_a, of_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [both.bytes_a[i].as_py() for i in of_a]
    bytes_b = [both.bytes_b[i].as_py() for i in of_b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    ends_a, ends_b = (np.cumsum([len(x) for x in spelled]).tolist() for spelled in (bytes_a, bytes_b))
    groups, links, i, j, open_a, open_b = [], [], 0, 0, [], []
    while i < len(of_a) or j < len(of_b):
        links.append((of_a[i], of_b[j]))
        end_a, end_b = ends_a[i], ends_b[j]
        if end_a <= end_b:
            open_a.append(of_a[i])
            i += 1
        if end_b <= end_a:
            open_b.append(of_b[j])
            j += 1
        if end_a == end_b:
            groups.append(",".join(map(str, open_a)) + "|" + ",".join(map(str, open_b)))
            open_a, open_b = [], []
    return len(of_a), len(of_b), groups, links


def expected(libraries, texts: list[str | None]) -> list[tuple]:
    found = [plainly(libraries, t) for t in texts]
    seen = Counter(link for f in found if f for link in set(f[3]))
    best = Counter()
    for (a, _), n in seen.items():
        best[a] = max(best[a], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None else (
            f[0], f[1], len(f[2]), len(f[3]), sum(seen[x] == best[x[0]] for x in f[3]), sum(seen[x] for x in f[3]),
            hashlib.sha256(";".join(f[2]).encode()).hexdigest(),
        )
        for f in found
    ]


def test_batches_of_odd_texts(libraries):
    rng = random.Random(4)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0xD7FF), rng.randrange(32, 0x250)])) for _ in range(60)) for _ in range(300)]
    texts += ["", None, " ", "▁"]
    wanted = expected(libraries, texts)
    found = token_alignment.aligned_batch(libraries[2], pa.array(texts))
    names = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    assert [tuple(found[n][i] for n in names) for i in range(len(texts))] == [(*w[:4], w[6]) for w in wanted]


@pytest.mark.parametrize("frequent", [token_alignment.FREQUENT, 100, 0])
def test_whole_table(spark, libraries, frequent):
    documents = table(spark, SF_DIR, "documents")
    rows = documents.select("doc_id", "text").collect()
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    found = {r.doc_id: tuple(r[n] for n in names) for r in token_alignment.alignment(documents, A, B, frequent).collect()}
    assert found == dict(zip([r.doc_id for r in rows], expected(libraries, [r.text for r in rows]), strict=True))
