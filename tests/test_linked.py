"""Versions that link what they do not replace: what is read and written, readers meanwhile, runs that end early."""

from __future__ import annotations

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pitlane.operators import merge
from pitlane.plans import pipeline
from pitlane.sources import linked, tables


def documents(spark, ids, v):
    rows = spark.createDataFrame([(f"k{i}", v) for i in ids], "id string, v int")
    return rows.withColumn("ingested_at", F.lit(f"2024-01-{v:02d}").cast("timestamp"))


def seen(day: int):
    return F.lit(f"2024-02-{day:02d}").cast("timestamp")


def files(root: str) -> dict[str, int]:
    return {str(p): p.stat().st_size for p in Path(root, "data").rglob("*.parquet")}


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    """One in a hundred keys, all in few buckets: the bytes of these, and the rows of a plain merge."""
    root = str(tmp_path / "t")
    first = documents(spark, range(20_000), 1)
    pipeline.merge_landed(first, root, "id", seen(1), buckets=64)
    whole = files(root)
    few = [r["i"] for r in spark.range(20_000).select(
        F.col("id").alias("i"), linked.bucket_of(F.concat(F.lit("k"), F.col("id").cast("string")), 64).alias("b")
    ).where("b < 2").limit(200).collect()]
    batch = documents(spark, few, 2)
    assert pipeline.merge_landed(batch, root, "id", seen(2))[:2] == (0, len(few))
    touched = {f"_bucket={b}" for b in (0, 1)}
    new = {p: n for p, n in files(root).items() if p not in whole}
    assert {Path(p).parent.name for p in new} == touched
    held = sum(n for p, n in whole.items() if Path(p).parent.name in touched)
    assert sum(new.values()) < 2 * held < 2 * sum(whole.values()) / 20
    made = linked.manifest(spark, root)
    target = linked.read(spark, root, made, touched)
    assert {Path(p).parent.name for p in target.inputFiles()} == touched
    plain = merge.ingest_upsert(merge.ingest_upsert(merge.empty_target(first), first, "id", seen(1)), batch, "id", seen(2))
    assert sorted(map(tuple, pipeline.merged_table(spark, root).collect())) == sorted(map(tuple, plain.collect()))


def test_new_columns_and_types(spark, tmp_path):
    root = str(tmp_path / "t")
    pipeline.merge_landed(documents(spark, range(50), 1), root, "id", seen(1), buckets=8)
    pipeline.merge_landed(documents(spark, [3], 2).withColumn("w", F.lit("new")), root, "id", seen(2))
    found = {r["id"]: (r["v"], r["w"]) for r in pipeline.merged_table(spark, root).collect()}
    assert len(found) == 50 and found["k3"] == (2, "new") and found["k4"] == (1, None)
    # A field of another type: every bucket is written again.
    wider = documents(spark, [4], 3).withColumn("v", F.lit(2.5))
    pipeline.merge_landed(wider, root, "id", seen(3))
    found = {r["id"]: r["v"] for r in pipeline.merged_table(spark, root).collect()}
    assert len(found) == 50 and found["k4"] == 2.5 and found["k3"] == 2.0


@pytest.mark.parametrize("rows", [0, 2])
def test_nothing_usable_landed(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    batch = spark.createDataFrame([("", 1), (None, 2)][:rows], "id string, v int").withColumn("ingested_at", seen(1))
    assert pipeline.merge_landed(batch, root, "id", seen(1)) == (0, 0, 0, rows)
    assert pipeline.merged_table(spark, root).count() == 0
    pipeline.merge_landed(documents(spark, [1], 1), root, "id", seen(1))
    pipeline.merge_landed(batch, root, "id", seen(1))
    assert pipeline.merged_table(spark, root).count() == 1


def test_fields_by_age_whatever_the_order(spark):
    """Late documents fill what newer ones did not send; a batch and any split of it give the same."""
    specs = [("a", 1, None, 3, ["id", "v"]), ("a", None, "x", 2, ["id", "v", "w"]), ("a", 9, "y", 1, ["id", "v", "w"]),
             ("b", None, "z", 2, ["id", "w"]), ("b", 5, None, 1, ["id", "v", "w"]), ("b", 6, "u", 2, ["id", "v", "w"])]
    batch = spark.createDataFrame(specs, "id string, v int, w string, day int, _present array<string>").withColumn(
        "ingested_at", F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, day)")).drop("day")
    rows = [batch.where(F.col("id").isin(i) & (F.dayofmonth("ingested_at") == d)) for i in "ab" for d in (2, 3, 4)]

    def state(parts):
        table = merge.empty_target(batch, by_field=True)
        for part in parts:
            table = merge.ingest_upsert(table, part, "id", seen(1))
        return sorted(map(tuple, table.select("id", "v", "w").collect()))

    assert state([batch]) == state(rows) == state(rows[::-1]) == [("a", 1, "x"), ("b", 6, "z")]


def test_two_writers(spark, tmp_path):
    root = str(tmp_path / "t")
    base = linked.commit(spark.range(3), root)
    linked.commit(spark.range(4), root, base=base)
    with pytest.raises(linked.Refused):
        linked.commit(spark.range(5), root, base=base)
    assert linked.read(spark, root).count() == 4


def test_a_run_that_ends_early_changes_nothing(spark, tmp_path):
    gold = str(tmp_path)
    tables.gold_materialize(spark.range(3), gold, "mart")

    broken = spark.range(9).select(F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error("lost").cast("bigint")).alias("id"))
    with pytest.raises(Exception):
        tables.gold_materialize(broken, gold, "mart")
    assert tables.gold_read_mart(spark, gold, "mart").count() == 3
    tables.gold_materialize(spark.range(4), gold, "mart")
    assert tables.gold_read_mart(spark, gold, "mart").count() == 4


def test_a_reader_meanwhile_never_fails(spark, tmp_path):
    gold, seen_counts, failures, done = str(tmp_path), set(), [], threading.Event()
    tables.gold_materialize(spark.range(1, 2), gold, "mart")

    def reader():
        while not done.is_set():
            try:
                ids = [r["id"] for r in tables.gold_read_mart(spark, gold, "mart").collect()]
                seen_counts.add(len(ids))
                if len(set(ids)) != len(ids) or len(ids) != max(ids):
                    failures.append(ids)
            except Exception as error:  # noqa: BLE001
                failures.append(error)

    thread = threading.Thread(target=reader)
    thread.start()
    for n in range(2, 22):
        tables.gold_materialize(spark.range(1, n + 1).repartition(2), gold, "mart")
    done.set()
    thread.join()
    assert failures == [] and len(seen_counts) > 2
    # Old versions and their files go.
    assert len(list(Path(gold, "mart/_manifest").glob("*.json"))) == linked.KEEP
    assert len(list(Path(gold, "mart/data").iterdir())) == linked.KEEP


def test_refused_when_rows_lie_outside(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(6).withColumn("p", (F.col("id") % 3).cast("int"))
    base = linked.commit(rows, root, ["p"])
    with pytest.raises(ValueError):
        linked.commit(rows.where("p < 2"), root, ["p"], base, {"p=0"})
    assert linked.read(spark, root).count() == 6
    made = linked.commit(rows.where("p < 0"), root, ["p"], base, {"p=0"})
    assert set(made.owners) == {"p=1", "p=2"} and linked.read(spark, root).count() == 4
