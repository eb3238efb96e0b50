"""Token counts and byte-pair encoding against the library."""

from __future__ import annotations

import hashlib
import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF_DIR
from pitlane.llm import bpe, common, queries, token_counts

ODD = [
    "", " ", "  a  b ", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "İstanbul ΣΑΣ ǅ ﬁ é", "don't I'LL 123 ٣٤ !!!...",
    "\x1c\x1d a​ b\x85c\xa0d", "x" * 5000, "tab\t\tnew\n\n\nline \n end  ", "՘\U000107bb unassigned", "日本語 text",
]


def _random_texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    places = [(32, 127), (0x80, 0x3000), (0x10000, 0x1FFFF), (9, 14), (32, 48)]
    return ["".join(chr(rng.randrange(*rng.choice(places))) for _ in range(60)) for _ in range(300)]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    _agree([text])


def test_random_texts():
    _agree(_random_texts(1))


def _agree(texts: list[str]) -> None:
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = bpe.WordBpe(token_counts.Path(path).read_text()), Tokenizer.from_file(path)
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert own.encode(text) == ids and own.decode(ids) == decoded
        digests = hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        assert own.digests(text) == (len(ids), *digests)
    path = public_tokenizers.path("byte_bpe_50k.json")
    definition, library = token_counts.definition_of(path), Tokenizer.from_file(path)
    count = token_counts.counter(token_counts.PreTokens(definition), {" the": 1}, common.Recent(4))
    for text in texts:
        assert count(text)[0] == len(library.encode(text, add_special_tokens=False).ids)


def test_cuts_change_nothing():
    text = " ".join(["word", "a  b", "é!", "x\n y"] * 400)
    assert "".join(common.cuts(text, 50)) == text
    worker = token_counts.PreTokens(token_counts.definition_of(public_tokenizers.path("byte_bpe_50k.json")))
    assert [p for cut in common.cuts(text, 50) for p in worker.split(cut)] == worker.split(text)


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in common.table(spark, SF_DIR, "documents").collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in queries.op7_token_counts(spark, SF_DIR).collect():
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 1024)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in queries.op10_bpe(spark, SF_DIR).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest() and r.n_tokens == len(ids)


def test_ties_and_stale_entries():
    """Against merging one pair at a time."""
    own = bpe.WordBpe(token_counts.Path(public_tokenizers.path("word_bpe_49k.json")).read_text())
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("aaeinrst") for _ in range(rng.randrange(1, 30)))
        symbols = [own.inner[b] for b in word.encode()]
        symbols[-1] = own.last[word.encode()[-1]]
        slow = list(symbols)
        while True:
            ranked = [(own.merges[p][0], i) for i, p in enumerate(zip(slow, slow[1:])) if p in own.merges]
            if not ranked:
                break
            _, i = min(ranked)
            slow[i : i + 2] = [own.merges[slow[i], slow[i + 1]][1]]
        assert own.merged(symbols) == slow
