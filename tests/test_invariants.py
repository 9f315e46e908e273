"""Cross-model invariants on the driver tables (SURVEY 5 (d))."""

import pytest
from pyspark.sql import functions as F

from forgestat.plans import analysis
from forgestat.plans.catalog import warehouse_for

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse_for(spark, SF)


def test_weekly_and_monthly_merged_counts_agree(wh):
    m = {r["period_type"]: r["n"] for r in wh.pr_cycle_time.groupBy("period_type").agg(
        F.sum("merged_pr_count").alias("n")).collect()}
    assert m["weekly"] == m["monthly"] > 0


def test_new_plus_returning_is_unique(wh):
    bad = wh.contributor_engagement.filter(
        F.col("new_contributors") + F.col("returning_contributors") != F.col("unique_contributors"))
    assert bad.count() == 0
    r = analysis.q14_contributor_retention(wh)
    assert r.filter(F.col("new_contributors") + F.col("returning_contributors")
                    != F.col("active_contributors")).count() == 0


def test_last_cumulative_star_is_star_count(wh):
    cum = analysis.q09_cumulative_stars(wh).groupBy("repository_name").agg(
        F.max("cumulative_stars").alias("last"))
    stars = (wh.fct_stargazers.filter(F.col("starred_date_key").isNotNull())
             .join(wh.dim_repositories.select("repo_key", "repository_name"), "repo_key")
             .groupBy("repository_name").agg(F.count(F.lit(1)).alias("n")))
    assert cum.join(stars, "repository_name").filter(F.col("last") != F.col("n")).count() == 0
    assert cum.count() == stars.count() > 0


def test_release_counts_cover_published_non_drafts(wh):
    rv = wh.release_velocity
    per = {r["period_type"]: r["n"] for r in rv.groupBy("period_type").agg(F.sum("release_count").alias("n")).collect()}
    expected = wh.stg_releases.filter((F.col("is_draft") == False) & F.col("published_at").isNotNull()).count()  # noqa: E712
    assert per["monthly"] == per["quarterly"] == expected


def test_fact_user_keys_match_dim_users(wh):
    # the join elimination (author_key = md5(author_id)) equals the planned join
    from forgestat.plans.warehouse import Warehouse
    joined = Warehouse(wh.spark, wh.bronze, wh.params, users_join=True, date_join=True)
    a = wh.fct_pull_requests.select("pr_key", "author_key", "created_date_key", "merged_date_key", "closed_date_key")
    b = joined.fct_pull_requests.select("pr_key", "author_key", "created_date_key", "merged_date_key", "closed_date_key")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bot_flags_do_not_gather_a_heavy_user(spark):
    """One user with a third of the activities (and one with none known): flags as
    in a plain join, and no shuffle partition far above the median."""
    from pyspark.sql import functions as F

    from forgestat.operators import intermediate
    n = 30_000
    act = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500 + 100).cast("long").alias("user_id"), F.lit("l").alias("user_login"),
        F.lit("o/r").alias("repository_full_name"), F.lit("commit_created").alias("activity_type"),
        F.lit("2026-01-05 01:00:00").cast("timestamp_ntz").alias("activity_at"), F.col("id").cast("string").alias("activity_id"))
    users = spark.createDataFrame([(7, True)] + [(k, k % 2 == 0) for k in range(100, 590)], "user_id long, is_bot boolean")
    got = intermediate.with_bot_flag(act, users, heavy_rows=2_000)
    expected = act.join(users, "user_id", "left").groupBy("user_id", "is_bot").count()
    assert sorted(map(str, got.groupBy("user_id", "is_bot").count().collect())) == sorted(map(str, expected.collect()))
    for setting, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(setting, value)
    try:
        sizes = [r["count"] for r in intermediate.with_bot_flag(act, users, heavy_rows=2_000)
                 .groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]
