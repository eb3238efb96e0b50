from __future__ import annotations

from conftest import SF_DIR
from pitlane.operators import silver
from pitlane.plans.lake import Lake
from pitlane.sources import shared


def test_silver_by_months_is_written_once_and_read_by_all(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(shared, "store", lambda df, name: written.append(name) or df)
    lake = Lake(spark, SF_DIR)
    for dataset in silver.CLEANERS:
        lake.write_silver(dataset, f"{tmp_path}/{dataset}")
    stored = {dataset: lake.silver(dataset) for dataset in silver.CLEANERS}
    assert written == []
    for dataset, rows in stored.items():
        cleaned = silver.CLEANERS[dataset](lake.raw(dataset))
        assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in cleaned.schema]
        assert rows.count() > 0 and rows.exceptAll(cleaned).count() == cleaned.exceptAll(rows).count() == 0
