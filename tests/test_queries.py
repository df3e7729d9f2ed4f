"""Every registered query of the engine's own operators against DuckDB."""

from __future__ import annotations

import pytest

from foliant.plans.registry import ORACLES, QUERIES
from tests.compare import assert_same

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, name):
    assert assert_same(QUERIES[name](spark, SF), ORACLES[name], SF) > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_runs(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
