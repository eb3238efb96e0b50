"""The rest of the library without the training-data part, or without a library that part needs."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.partition('.')[0] == {absent!r} or name == {absent!r} or name.startswith({absent!r} + '.'):
            raise ModuleNotFoundError(name, name=name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
queries, sql = entry.queries(), entry.oracle_sql()
assert 'mart_market_pricing' in queries and set(sql) <= set(queries), sorted(set(sql) - set(queries))
assert not any(name.startswith('op') for name in queries)
print('pipeline' in queries)
"""


@pytest.mark.parametrize("absent", ["pitlane.llm", "tokenizers", "public_tokenizers", "zstandard", "sentencepiece"])
def test_entry_loads(absent):
    run = subprocess.run(
        [sys.executable, "-c", CODE.format(absent=absent)], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True
    )
    # The pipeline needs neither of the two last libraries.
    assert run.stdout.strip() == str(absent in ("zstandard", "sentencepiece"))
