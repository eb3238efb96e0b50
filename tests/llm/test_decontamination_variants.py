"""Benchmark items of one template with different fillings."""

from __future__ import annotations

from pitlane.llm import decontaminate

TOLD = "yesterday somebody bought {} apples and {} pears at the market, then walked {} km along the river to see a friend"
#: The first repeats a filling, which a copy of the second does not.
ITEMS = [(1, TOLD.format(12, 12, 3)), (2, TOLD.format(40, 41, 3)), (3, TOLD.format(40, 41, 3)), (None, TOLD.format(7, 8, 9))]


def _frames(spark, texts):
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return documents, spark.createDataFrame(ITEMS, "item_id long, text string")


def test_each_filling_of_a_template_is_tested(spark):
    texts = [f"some words before. {TOLD.format(*f)} and after" for f in ((40, 41, 3), (12, 12, 3), (5, 5, 5))]
    documents, items = _frames(spark, [*texts, "nothing of the kind"])
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents, items).collect()}
    # 12 apples and 12 pears can't become 40 and 41; other fillings, all distinct, may become anything.
    assert found == {
        *((0, i) for i in (2, 3, None)), *((d, i) for d in (1, 2) for i in (1, 2, 3, None)),
    }
    assert [r.doc_id for r in decontaminate.without_contaminated(documents, items).collect()] == [3]


def test_repeated_documents_and_items(spark):
    documents, items = _frames(spark, [TOLD.format(40, 41, 3)])
    found = decontaminate.contaminated(documents.unionAll(documents), items.unionAll(items))
    assert sorted((r.doc_id, r.item_id or 0) for r in found.collect()) == [(0, 0), (0, 2), (0, 3)]
