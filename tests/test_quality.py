import datetime as dt

from conftest import rows
from forgestat.operators import quality


def test_checks_return_failing_rows(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (None, "c", None), (3, None, 2)],
                               "k bigint, v string, h bigint")
    assert [r["k"] for r in rows(quality.unique_failures(df, "k"))] == [1]
    thrice = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k bigint")
    assert [r["failures"] for r in rows(quality.profile(thrice, quality.ModelTests("m", unique=["k"])))] == [1]
    assert len(rows(quality.not_null_failures(df, "v"))) == 1
    parent = spark.createDataFrame([(1,), (2,)], "k bigint")
    assert [r["k"] for r in rows(quality.relationship_failures(df, "k", parent, "k"))] == [3]
    assert [r["v"] for r in rows(quality.accepted_values_failures(df, "v", ["a", "c"]))] == ["b"]
    assert [r["h"] for r in rows(quality.expression_failures(df, "h >= 0", "h is not null"))] == [-1]
    spec = quality.ModelTests("m", unique=["k"], not_null=["v", "k"], expressions=[("h", "h >= 0", "h is not null")],
                              accepted=[("v", ["a", "c"])])
    prof = {(r["test"], r["column_name"]): r["failures"] for r in rows(quality.profile(df, spec))}
    assert prof == {("unique", "k"): 1, ("not_null", "v"): 1, ("not_null", "k"): 1,
                    ("expression_is_true", "h"): 1, ("accepted_values", "v"): 1}


def test_declared_tests_in_one_pass(spark, tmp_path):
    """All kinds over several models: the summary, and a folder per failing test only."""
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k bigint, v string")
    child = spark.createDataFrame([(10, 1, 5), (11, 3, -1), (12, 3, None), (13, None, 2), (13, 2, 2)], "c bigint, k bigint, h bigint")
    specs = [quality.ModelTests("child", unique=["c"], not_null=["c", "k"], expressions=[("h", "h >= 0", "h is not null"), ("h", "h < 5", None)],
                                relationships=[("k", "parent", "k"), ("c", "parent", "k")]),
             quality.ModelTests("parent", unique=["k"], not_null=["v"], accepted=[("v", ["a", "b", "c"])])]
    models = {"child": child, "parent": parent}
    expected = [("child", "unique", "c", 1), ("child", "not_null", "c", 0), ("child", "not_null", "k", 1),
                ("child", "expression_is_true", "h", 1), ("child", "expression_is_true", "h", 1),
                ("child", "relationships", "k", 2), ("child", "relationships", "c", 5),
                ("parent", "unique", "k", 1), ("parent", "not_null", "v", 0), ("parent", "accepted_values", "v", 1)]
    assert sorted(tuple(r) for r in quality.run_mart_tests(models, specs).collect()) == sorted(expected)
    path, summary = quality.store_declared_failures(models, specs, str(tmp_path))
    assert sorted(tuple(r) for r in summary.collect()) == sorted(expected)
    folders = {p.name for p in (tmp_path / "test_results" / "declared").iterdir() if p.is_dir()}
    assert folders == {f"test_name={t}_{m}_{c}" for m, t, c, n in expected if n}
    stored = spark.read.parquet(path).filter("test_name = 'relationships_child_k'").collect()
    assert [(r["key"], r["n_records"]) for r in stored] == [("3", 2)]
    none, summary = quality.store_declared_failures({"parent": parent}, [quality.ModelTests("parent", not_null=["v"])], str(tmp_path / "ok"))
    assert [r["failures"] for r in summary.collect()] == [0]


def test_singular_tests(spark):
    f = spark.createDataFrame([("p1", 1, "r", True, -3), ("p2", 2, None, True, 4), ("p3", 3, "r", False, None)],
                              "pr_key string, pull_request_id bigint, repo_key string, is_merged boolean, "
                              "time_to_merge_hours bigint")
    assert [r["pr_key"] for r in rows(quality.orphan_prs(f))] == ["p2"]
    assert [r["pr_key"] for r in rows(quality.negative_cycle_time(f))] == ["p1"]


def test_freshness_thresholds(spark):
    # fixture group "freshness": as-of minus 23 h, 25 h, 73 h, empty table
    as_of = dt.datetime(2026, 1, 10, 12, 0, 0)
    for hours, status in ((23, "pass"), (25, "warn"), (73, "error")):
        df = spark.createDataFrame([(as_of - dt.timedelta(hours=hours),)], "updated_at timestamp_ntz")
        r = rows(quality.freshness(df, "issues", "updated_at", as_of))[0]
        assert r["status"] == status and abs(r["age_hours"] - hours) < 1e-9
    empty = spark.createDataFrame([], "updated_at timestamp_ntz")
    assert rows(quality.freshness(empty, "issues", "updated_at", as_of))[0]["status"] == "error"


def test_store_failures(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "k bigint")
    path = quality.store_failures(df, str(tmp_path), "unique_x")
    assert spark.read.parquet(path).count() == 1
