"""The queries that SQL can express, against DuckDB on sf0.001."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from forgestat.llm import registry  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    res = compare(spark, name, registry.QUERIES[name], registry.ORACLE_SQL[name], SF, duck(SF))
    assert res["status"] == "OK", res
