import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from forgestat.operators import intermediate, staging
from forgestat.sources.landing import child_table


def test_comment_url_issue_number(spark):
    # fixture group "comment URL" (P12)
    base = "https://api.example/repos/o/r"
    data = [(1, f"{base}/issues/12"), (2, f"{base}/issues/12/"), (3, f"{base}/pull/3"), (4, None)]
    df = spark.createDataFrame(data, "id bigint, issue_url string").select(
        "id", F.lit("n").alias("node_id"), "issue_url", F.lit("hi").alias("body"), F.lit("u").alias("user__login"),
        F.lit(1).cast("bigint").alias("user__id"), F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"), F.lit("o").alias("_owner"), F.lit("r").alias("_repo"))
    lenient = {r["comment_id"]: r["issue_number"] for r in rows(staging.stg_issue_comments(df, strict=False))}
    assert lenient == {1: 12, 2: None, 3: None, 4: None}
    # strict mode fails like the reference on a URL without a trailing number
    with pytest.raises(Exception):
        staging.stg_issue_comments(df.filter("id = 2"), strict=True).collect()
    assert rows(staging.stg_issue_comments(df.filter("id in (1, 4)"), strict=True), ["comment_id"])[0]["comment_length"] == 2


def _issues_with_labels(spark, label_sets):
    lab = "array<struct<id:bigint,name:string,color:string,description:string,default:boolean>>"
    data = [(i, f"rid{i}", [(k, n, "c", "d", False) for k, n in enumerate(names)]) for i, names in enumerate(label_sets)]
    return spark.createDataFrame(data, f"id bigint, _row_id string, labels {lab}")


def test_label_flags(spark):
    # fixture group "labels"
    sets = [["Bug"], ["bug"], ["feature"], ["Enhancement"], ["debug"], []]
    parents = _issues_with_labels(spark, sets)
    labels = staging.stg_issue_labels(child_table(parents, "labels"))
    assert labels.count() == 5
    assert rows(labels.filter("issue_dlt_id = 'rid0'"))[0]["label_position"] == 0
    issues = parents.select(F.col("id").alias("issue_id"), F.col("_row_id").alias("issue_dlt_id"),
                            F.col("id").alias("issue_number"), F.lit("o/r").alias("repository_full_name"),
                            F.lit("t").alias("issue_title"), F.lit("open").alias("issue_state"),
                            F.lit("u").alias("author_login"), F.lit(1).cast("bigint").alias("author_id"),
                            F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz").alias("created_at"),
                            F.lit(None).cast("timestamp_ntz").alias("updated_at"),
                            F.lit(None).cast("timestamp_ntz").alias("closed_at"),
                            F.lit(None).cast("bigint").alias("assignee_id"))
    empty_comments = spark.createDataFrame([], "repository_full_name string, issue_number bigint, comment_count bigint, first_comment_at timestamp_ntz")
    lc = {r["issue_id"]: (r["is_bug"], r["is_enhancement"], r["label_count"])
          for r in rows(intermediate.int_issue_lifecycle(issues, labels, empty_comments))}
    assert lc == {0: (True, False, 1), 1: (True, False, 1), 2: (False, True, 1), 3: (False, True, 1),
                  4: (False, False, 1), 5: (False, False, 0)}


def test_users_min_login_and_sources(spark):
    # fixture group "logins": two logins for one id; NULL id dropped
    issues = spark.createDataFrame([(1, "zed"), (None, "ghost")], "author_id bigint, author_login string")
    prs = spark.createDataFrame([(1, "amy")], "author_id bigint, author_login string")
    comments = spark.createDataFrame([(2, "renovate")], "author_id bigint, author_login string")
    commits = spark.createDataFrame([(3, "x[bot]")], "author_id bigint, author_login string")
    stars = spark.createDataFrame([(4, "abbott")], "user_id bigint, user_login string")
    u = {r["user_id"]: (r["user_login"], r["is_bot"]) for r in rows(staging.stg_users(issues, prs, comments, commits, stars))}
    assert u == {1: ("amy", False), 2: ("renovate", True), 3: ("x[bot]", True), 4: ("abbott", True)}


def test_exclude_pull_requests_option(spark):
    cols = ("id bigint, node_id string, _row_id string, number bigint, title string, body string, state string, "
            "locked boolean, user__login string, user__id bigint, assignee__login string, assignee__id bigint, "
            "comments int, created_at timestamp_ntz, updated_at timestamp_ntz, closed_at timestamp_ntz, "
            "pull_request__url string, _owner string, _repo string")
    base = ("n", "r", 1, "t", None, "open", False, "u", 1, None, None, 0, None, None, None)
    df = spark.createDataFrame([(1,) + base + (None, "o", "r"), (2,) + base + ("https://x/pull/1", "o", "r")], cols)
    assert staging.stg_issues(df).count() == 2          # the reference SQL keeps PRs (D1)
    assert staging.stg_issues(df, exclude_pull_requests=True).count() == 1


def test_users_meet_the_string_minimum_as_distinct_pairs(spark):
    from forgestat.operators.staging import users_of
    pairs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, None), (2, "x[bot]"), (3, None)], "user_id long, user_login string")
    got = users_of(pairs)
    assert sorted(map(tuple, got.collect())) == [(1, "a", False), (2, "x[bot]", True), (3, None, False)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[user_id" in plan      # the duplicates go before anything is sorted


def test_the_comment_merge_does_not_sort_in_the_scan(spark):
    from forgestat.plans.catalog import warehouse_for
    plan = warehouse_for(spark, "/root/testdata/sf0.001").adapters.issue_comments.select("id", "body")
    plan = plan._jdf.queryExecution().executedPlan().toString()
    above_scan = plan[:plan.index("l_linenumber", plan.index("FileScan parquet [l_orderkey"))].rsplit("SortAggregate", 1)[1]
    assert "Exchange hashpartitioning(l_orderkey" in above_scan


def test_a_scan_of_a_large_row_group_only_sends_its_rows_on(spark):
    """Nothing on a scan sorts or aggregates, or is dealt over so many partitions that the
    shuffle's writer holds all rows of its task."""
    import re

    from forgestat.plans.catalog import warehouse_for
    wh = warehouse_for(spark, "/root/testdata/sf0.001")
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.conf.set(first, "700")
    try:
        from forgestat.sources.adapters import DriverBronze
        bronze = DriverBronze(spark, "/root/testdata/sf0.001", wh.params)
        for name in (*DriverBronze.ENTITIES[1:], "pr_reviews"):
            plan = getattr(bronze, name)._jdf.queryExecution().executedPlan().toString().splitlines()
            scans = [k for k, line in enumerate(plan) if re.search(r"FileScan parquet \[(l_|o_|c_|event_|ts)", line)]
            assert scans, name
            for k in scans:
                above = next(j for j in range(k, -1, -1) if "Exchange" in plan[j])
                assert "REPARTITION_BY_NUM" in plan[above] and int(re.search(r", (\d+)\), REPA", plan[above])[1]) <= 200, (name, plan[above])
                assert not any("Sort" in line or "Aggregate" in line for line in plan[above:k]), name
    finally:
        spark.conf.unset(first)
