"""Published tables answer the analytical SQL unchanged via spark.sql, and
agree with the DataFrame implementations."""

import math
import re

import pytest

from forgestat.plans import analysis
from forgestat.plans.catalog import Q_SQL
from forgestat.plans.warehouse import driver_warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def published(spark):
    wh = driver_warehouse(spark, SF)
    wh.publish("marts")
    wh.publish("intermediate", models=("int_contributor_activity",))
    return wh


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 6) if isinstance(v, float) and not math.isnan(v) else v for v in r))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


SCHEMAS = dict.fromkeys(("fct_pull_requests", "fct_issues", "fct_stargazers", "dim_repositories", "dim_users", "dim_dates",
                         "pr_cycle_time", "contributor_engagement", "release_velocity"), "marts")
SCHEMAS["int_contributor_activity"] = "intermediate"


def _qualify(sql: str) -> str:
    """Schema names before the published tables, wherever the statement breaks or ends."""
    return re.sub(r"(?i)\b(from|join)(\s+)(" + "|".join(SCHEMAS) + r")\b",
                  lambda m: f"{m[1]}{m[2]}{SCHEMAS[m[3]]}.{m[3]}", sql)


@pytest.mark.parametrize("name", sorted(analysis.QUERIES))
def test_sql_on_published_tables(spark, published, name):
    sql, _ = Q_SQL[name]
    got = spark.sql(_qualify(sql))
    exp = analysis.QUERIES[name](published)
    assert sorted(got.columns) == sorted(exp.columns)
    cols = sorted(exp.columns)
    a = _norm([tuple(r[c] for c in cols) for r in got.collect()])
    b = _norm([tuple(r[c] for c in cols) for r in exp.collect()])
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, float) and isinstance(v, float):
                assert abs(u - v) <= 0.0100001, (name, x, y)   # Spark's round vs the engine's on ties
            else:
                assert u == v, (name, x, y)
