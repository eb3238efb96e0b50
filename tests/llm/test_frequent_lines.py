"""Frequent lines: found whatever their length, and gone from what is handed on."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from conftest import SF_DIR

from pitlane.llm import line_quality
from pitlane.llm.common import table

NOTICE = " ".join(f"notice{i}" for i in range(60))


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))


def normal(line: str) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", line.lower())).strip(" ")


def plainly(rows: list[tuple]) -> dict[int, str]:
    """Texts without frequent lines, by loops."""
    held, hosts = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        lines = sorted({normal(x) for x in (text or "").split("\n")} - {""}, key=lambda x: (len(x), x.encode()), reverse=True)
        for line in lines:
            other = [x for x in lines if x != line]
            held[host, line].add(other[0] if other else line)
        if lines:
            hosts[host].add(tuple(lines[:2]))
    often = {k for k, v in held.items() if len(v) >= 10 and 1000 * len(v) >= 10 * len(hosts[k[0]])}
    return {i: "\n".join(x for x in (t or "").split("\n") if (h, normal(x)) not in often) for i, t, h in rows}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = [(i, f"{words(rng, 70)}\n{NOTICE.upper()}\n\n{words(rng, 30)}", "a") for i in range(300)]
    out += [(1000 + i, f"{words(rng, 12)}\n{NOTICE}\n{NOTICE}\t", "a") for i in range(20)]  # depleted
    copied = words(rng, 80) + "\nsecond " + words(rng, 20)
    out += [(2000 + i, copied, "b") for i in range(400)]  # copies are no boilerplate
    out += [(3000 + i, f"{words(rng, 60)}\nPage {i} of 9\n", "b") for i in range(40)]
    out += [(4000, None, "b"), (4001, "", None), (4002, words(rng, 60), None)]
    return out


def test_long_lines_are_counted_and_taken_out(spark, rows):
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "length(text) as n_chars", "1 as others", "2 as rest", "3 as own", "4 as salt", "5 as cut"
    ).repartition(3)
    kept = {r.doc_id: r for r in line_quality.kept_documents(documents).collect()}
    wanted = plainly(rows)
    texts = {i: t for i, t, _ in rows}
    assert set(kept) == {i for i in texts if i < 1000 or 2000 <= i < 4000 or i == 4002}
    assert all(r.text == wanted[i] and r.n_chars == len(r.text) for i, r in kept.items())
    assert not any(NOTICE in r.text.lower() for r in kept.values())
    assert all(kept[i].text == texts[i] for i in range(2000, 2400))
    assert (kept[5].others, kept[5].rest, kept[5].own, kept[5].salt, kept[5].cut) == (1, 2, 3, 4, 5)
    counted = {r.doc_id: r.n_lost_words for r in line_quality.line_quality(documents).collect()}
    assert counted[0] == 60 and counted[1000] == 120 and counted[2000] == 0 and counted[3000] == 4


def test_whole_table(spark):
    documents = table(spark, SF_DIR, "documents")
    wanted = plainly([(r.doc_id, r.text, r.source) for r in documents.collect()])
    kept = line_quality.kept_documents(documents)
    assert kept.schema.simpleString() == documents.schema.simpleString()
    assert all(r.text == wanted[r.doc_id] and r.n_chars == len(r.text) for r in kept.collect())


def test_texts_are_not_shuffled(spark):
    plan = line_quality.kept_documents(table(spark, SF_DIR, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Python" not in plan
