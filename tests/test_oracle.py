"""Each query that has oracle SQL gives the oracle's rows."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from conftest import SF  # noqa: E402
from oracle import same  # noqa: E402

from textloom.plans.catalog import REGISTRY  # noqa: E402


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.entries.items() if q.sql])
def test_oracle(spark, name):
    q = REGISTRY.entries[name]
    assert same(spark, q.build, q.sql, SF) > 0
