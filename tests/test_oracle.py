"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as se  # noqa: E402
from forgestat.plans import catalog  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.queries())      # the training-data queries have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(NAMES) <= set(se.queries())


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "median_hours_to_merge" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, se.queries()[name], se.oracle_sql().get(name), SF, con)
    assert res["status"] == "OK", res
