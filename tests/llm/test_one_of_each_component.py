"""One row of each component is left, whatever the ids are."""

from __future__ import annotations

import random

from pitlane.llm import neardup


def test_repeated_shared_and_missing_ids(spark):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(100)) for _ in range(6)]
    near = texts[1] + " more"
    rows = [
        *[(1, texts[0])] * 5,  # repeated rows
        (2, texts[1]), (2, near), (3, near),  # near copies that share an id
        *[(None, texts[2])] * 4,  # copies without an id
        (4, texts[3]), (None, texts[3]),  # a copy without an id of a row that has one
        (5, texts[4]), (5, texts[5]),  # one id for unrelated texts
        (6, ""), (6, ""), (None, None),  # empty sets
    ]
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    left = neardup.without_near_duplicates(df)
    found = [(r.doc_id, r.text) for r in left.collect()]
    assert left.columns == df.columns
    assert sum(f in ((2, texts[1]), (2, near)) for f in found) == 1
    rest = sorted((str(f) for f in found if f[0] != 2))
    assert rest == sorted(map(str, [
        (1, texts[0]), (None, texts[2]), (4, texts[3]), (5, texts[4]), (5, texts[5]), (6, ""), (6, ""), (None, None),
    ]))
