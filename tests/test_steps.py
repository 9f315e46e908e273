"""What a query leaves on disk while it runs: few shuffles, and steps that end."""

import re
import time

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def large(spark):
    """As with large tables: nothing is broadcast by its estimate, shuffles have many partitions."""
    values = {"spark.sql.autoBroadcastJoinThreshold": "1", "spark.sql.shuffle.partitions": "700"}
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def bronze(spark):
    from forgestat.params import DRIVER_PARAMS
    from forgestat.sources.adapters import DriverBronze
    return DriverBronze(spark, SF, DRIVER_PARAMS)


def shuffle_files(spark) -> int:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in str(blocks.apply(k)) for k in range(blocks.size()))


def plan_of(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def moved(plan: list[str], columns: str) -> list[str]:
    """The exchanges above each scan of these columns, up to the first join or aggregation."""
    out = []
    for k in (k for k, line in enumerate(plan) if re.search(f"FileScan parquet \\[{columns}", line)):
        top = next(j for j in range(k, -1, -1) if "Join" in plan[j] or "Aggregate" in plan[j] or "Union" in plan[j])
        out.append([line for line in plan[top:k] if "Exchange hash" in line])
    return out


def test_line_items_are_moved_once_for_the_step_on_them(large):
    """Dealt out by the key of the merge, aggregation or join that follows, also where the
    session has more partitions than a scan is dealt to."""
    tables = bronze(large)
    for name in ("issue_comments", "issues", "stargazers", "pr_reviews", "issue_comments_facts"):
        found = moved(plan_of(getattr(tables, name)), "l_orderkey")
        assert found and all(len(x) == 1 and ", 200), REPARTITION_BY_NUM" in x[0] for x in found), (name, found)


def test_a_merge_into_merged_rows_moves_nothing_again(large):
    """Existing rows and batch are dealt out by id, so their union is merged where it is."""
    from forgestat.plans import catalog
    plan = plan_of(catalog.queries()["src11b_merge_into_existing"](large, SF))
    union = next(k for k, line in enumerate(plan) if "Union" in line)
    assert sum("SortAggregate" in line for line in plan[:union]) == 2 and not any("Exchange" in line for line in plan[:union])


def test_small_tables_are_broadcast_behind_their_count(large):
    """Repositories and suppliers, by no estimate: then no fact is moved for them."""
    def broadcast(tables):
        return {c for x in plan_of(tables.stargazers) if "BroadcastHashJoin" in x for c in ("s_nationkey", "l_suppkey") if f"[{c}#" in x}
    assert broadcast(bronze(large)) == {"s_nationkey", "l_suppkey"}
    many = bronze(large)
    many.known_rows = {"repo_map": 25, "supplier": 3_000_000}
    assert broadcast(many) == {"s_nationkey"}


def read_by(df) -> set[str]:
    """The tables and saved steps that a query's plan reads."""
    names = re.findall(r"/(?:step-)?(\w+?)(?:-[0-9a-f]{32}|\.parquet)", " ".join(df.inputFiles()))
    return set(names)


def test_a_step_ends_with_its_shuffle_files(spark):
    from forgestat.functions.steps import CLEANUP, saved
    rows = spark.range(5000).selectExpr("id % 700 AS k", "id AS v")
    count, before = rows.groupBy("k").agg({"v": "max"}), shuffle_files(spark)
    setting = spark.conf.get(CLEANUP, None)
    got = saved(count, "counted")
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before and spark.conf.get(CLEANUP, None) == setting
    assert got.schema == count.schema and sorted(got.collect()) == sorted(count.collect())


def test_months_of_activity_keep_no_shuffles_of_comments_and_stars(spark):
    from forgestat.plans import catalog
    for name in ("q07_top_contributors", "m24_contributor_engagement"):
        read = read_by(catalog.queries()[name](spark, SF))
        assert {"comment_authors", "star_logins"} <= read and not read & {"lineitem", "supplier"}, (name, read)


def test_activity_reads_users_and_comments_that_are_written(spark):
    from forgestat.plans import catalog
    read = read_by(catalog.queries()["m13_int_contributor_activity"](spark, SF))
    assert {"comment_authors", "stg_users"} <= read and not read & {"lineitem", "supplier"}, read


@pytest.mark.parametrize("name", ["m20j_fct_issues_joined", "m19j_fct_pull_requests_joined"])
def test_joined_facts_read_users_and_comment_stats_that_are_written(spark, name):
    from forgestat.plans import catalog
    df = catalog.queries()[name](spark, SF)
    assert {"comment_stats", "stg_users"} <= read_by(df)
    assert sum("FileScan parquet [l_orderkey" in x for x in plan_of(df)) == 1      # the last ship dates


def test_pull_requests_with_reviews_join_steps_that_are_written(spark):
    from forgestat.plans import catalog
    read = read_by(catalog.queries()["m15r_int_pr_with_reviews_enabled"](spark, SF))
    assert read == {"comment_stats", "review_stats", "labelled_prs"}, read


def test_declared_tests_in_steps_are_those_in_one_pass(spark):
    from forgestat.operators import quality
    from forgestat.plans import catalog
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k bigint, v string")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, 3), (13, None), (13, 2)], "c bigint, k bigint")
    specs = [quality.ModelTests("child", unique=["c"], not_null=["k"], relationships=[("k", "parent", "k")]),
             quality.ModelTests("parent", unique=["k"], accepted=[("v", ["a", "b", "c"])])]
    models = {"child": child, "parent": parent}
    got = quality.run_tests_in_steps(models, [[s] for s in specs])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, quality.run_mart_tests(models, specs).collect()))
    assert all("/step-tests-" in f for f in got.inputFiles())
    listed = sorted(s.model for specs in catalog._LAYER_STEPS for s in specs)
    assert listed == sorted(s.model for s in quality.SOURCE_TESTS + quality.STAGING_TESTS)
    assert sorted(s.model for specs in catalog._MART_STEPS for s in specs) == sorted(s.model for s in quality.MART_TESTS)


@pytest.mark.parametrize("name", ["t01_t02_source_staging_tests", "t01_t05_mart_tests"])
def test_declared_tests_hold_no_shuffles_of_models(spark, name):
    from forgestat.plans import catalog
    assert all("/step-tests-" in f for f in catalog.queries()[name](spark, SF).inputFiles())
