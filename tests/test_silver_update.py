"""Silver kept up load by load against silver built anew."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

import rows
from pitlane.operators.silver import CLEANERS, DATASETS
from pitlane.plans import pipeline
from pitlane.sources import linked, tables

MAKERS = {"parts_catalog": rows.parts, "market_listings": rows.listings, "vehicle_recalls": rows.recalls}
IDS = {"parts_catalog": "_fingerprint", "market_listings": "listing_id", "vehicle_recalls": "recall_id"}


def loads(spark, name: str, seed: int):
    """Loads whose survivors change, move between months, repeat, arrive late, or drop out of silver."""
    rng = random.Random(seed)
    out = []
    for _ in range(4):
        specs = []
        for _ in range(25):
            spec = {IDS[name]: f"k{rng.randrange(18)}", "ingested_at": f"2024-{rng.randrange(1, 6):02d}-{rng.randrange(1, 28):02d}T00:00:00"}
            if name == "parts_catalog":
                spec |= {"part_id": f"p{rng.randrange(40)}", "price_eur": rng.choice([-1.0, 5.0, 7.0]),
                         IDS[name]: rng.choice([None, spec[IDS[name]], spec[IDS[name]]])}
            if name == "market_listings":
                spec["asking_price_eur"] = rng.choice([0.0, 10.0, 20.0])
            specs.append(spec)
        out.append(MAKERS[name](spark, *specs))
    return [*out, out[0]]


def content(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("name", MAKERS)
def test_equals_a_full_rebuild_after_each_load(spark, tmp_path, name):
    root, landed = str(tmp_path), None
    for load in loads(spark, name, 1):
        landed = load if landed is None else landed.unionByName(load)
        pipeline.silver_update(load, root, name, buckets=8)
        stored = linked.read(spark, f"{root}/{name}")
        assert content(stored) == content(CLEANERS[name](landed))
    assert pipeline.silver_update(load, root, name) == set()


def test_only_months_of_changed_survivors_are_written(spark, tmp_path):
    root = str(tmp_path)
    first = [{"recall_id": f"r{m}", "ingested_at": f"2024-{m:02d}-01T00:00:00"} for m in range(1, 7)]
    pipeline.silver_update(rows.recalls(spark, *first), root, "vehicle_recalls")
    before = linked.manifest(spark, f"{root}/vehicle_recalls")
    moved = rows.recalls(spark, {"recall_id": "r2", "ingested_at": "2024-05-09T00:00:00"}, {"recall_id": "r3", "ingested_at": "2023-01-01T00:00:00"})
    written = pipeline.silver_update(moved, root, "vehicle_recalls")
    assert written == {f"ingested_year=2024/ingested_month={m}" for m in (2, 5)}
    after = linked.manifest(spark, f"{root}/vehicle_recalls")
    assert {k for k, v in after.owners.items() if before.owners.get(k) != v} == {"ingested_year=2024/ingested_month=5"}
    assert "ingested_year=2024/ingested_month=2" not in after.owners
    files = {Path(f).parent.name for f in linked.read(spark, f"{root}/vehicle_recalls").inputFiles()}
    assert files == {f"ingested_month={m}" for m in (1, 3, 4, 5, 6)}


@pytest.mark.parametrize("first", [True, False])
def test_a_run_that_ends_between_silver_and_survivors(spark, tmp_path, monkeypatch, first):
    """Another load follows, and the one that was lost is landed again later."""
    root, (one, two, three, *_) = str(tmp_path), loads(spark, "market_listings", 2)
    done = []
    if not first:
        pipeline.silver_update(one, root, "market_listings")
        done.append(one)
    commit = linked.commit

    def failing(df, path, *rest, **more):
        if "_survivors" in path:
            raise RuntimeError("lost")
        return commit(df, path, *rest, **more)

    monkeypatch.setattr(linked, "commit", failing)
    with pytest.raises(RuntimeError):
        pipeline.silver_update(two, root, "market_listings")
    monkeypatch.setattr(linked, "commit", commit)
    for load in (three, two):
        pipeline.silver_update(load, root, "market_listings")
        done.append(load)
        landed = done[0]
        for part in done[1:]:
            landed = landed.unionByName(part)
        assert content(linked.read(spark, f"{root}/market_listings")) == content(CLEANERS["market_listings"](landed))


def test_silver_rebuilt_in_its_place(spark, tmp_path):
    """A plain rebuild removes the versions; the next load writes silver from the survivors."""
    root, (one, two, *_) = str(tmp_path), loads(spark, "parts_catalog", 3)
    pipeline.silver_update(one, root, "parts_catalog", buckets=8)
    tables.silver_write_partitioned(CLEANERS["parts_catalog"](one), f"{root}/parts_catalog")
    pipeline.silver_update(two, root, "parts_catalog")
    assert content(linked.read(spark, f"{root}/parts_catalog")) == content(CLEANERS["parts_catalog"](one.unionByName(two)))


def test_gold_reads_silver_that_is_kept_up(spark, tmp_path):
    root = str(tmp_path)
    for name, make in MAKERS.items():
        pipeline.silver_update(make(spark, {}), root, name)
    views = pipeline.staging_views(spark, root)
    assert [df.count() for df in views.values()] == [1, 1, 1]
    assert set(DATASETS) == set(CLEANERS)
