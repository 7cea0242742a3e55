"""Every registered query runs on the smallest tables and equals its SQL where it has one."""

from __future__ import annotations

from pathlib import Path

import pytest

from tools.check_oracle import compare, duck
from voxlode.plans import load_all

SF = "/root/testdata/sf0.001"
QUERIES = load_all()

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    status, note, _ = compare(spark, con, QUERIES[name], SF)
    assert status in ("ok", "rows"), note


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
