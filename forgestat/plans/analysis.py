"""Analytical queries (Q-01 ... Q-15) over the gold models.

Orderings state their NULL placement (NULLS LAST for both directions, as
the reference's engine does, SURVEY P3); top-k queries add a unique
tie-break. Queries that reduce a large stream (activity) aggregate to a
compact key first and join the dimension afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from forgestat.functions.numeric import round_scaled
from forgestat.functions.sizing import broadcast_if_bounded
from forgestat.operators import metrics
from forgestat.plans.warehouse import Warehouse


def _repos(wh: Warehouse) -> DataFrame:
    return wh.dim_repositories.select(F.col("repo_key").alias("_rk"), "repository_name")


def _with_repo(f: DataFrame, wh: Warehouse) -> DataFrame:
    r = _repos(wh)
    return f.join(r, f.repo_key == r._rk).drop("_rk")


def q01_repository_stats(wh: Warehouse) -> DataFrame:
    return wh.dim_repositories.select(
        "repository_name", "repository_full_name", "primary_language", "stargazers_count", "forks_count",
        "open_issues_count", "created_at", "pushed_at").orderBy(F.col("stargazers_count").desc_nulls_last())


def q02_pr_cycle_time_by_repo(wh: Warehouse) -> DataFrame:
    f = wh.fct_pull_requests.filter((F.col("is_merged") == True) & F.col("time_to_merge_hours").isNotNull())  # noqa: E712
    h = F.col("time_to_merge_hours")
    return (_with_repo(f, wh).groupBy("repository_name").agg(
        F.count(F.lit(1)).alias("total_merged_prs"),
        round_scaled(F.avg(h), 2).alias("avg_hours_to_merge"),
        round_scaled(F.median(h), 2).alias("median_hours_to_merge"),
        round_scaled(F.avg(h) / 24, 2).alias("avg_days_to_merge"),
        round_scaled(F.median(h) / 24, 2).alias("median_days_to_merge"))
        .orderBy(F.col("median_hours_to_merge").asc_nulls_last()))


def q03_pr_merge_rate(wh: Warehouse) -> DataFrame:
    merged = F.sum(F.when(F.col("is_merged"), 1).otherwise(0)).cast("bigint")
    return (_with_repo(wh.fct_pull_requests, wh).groupBy("repository_name").agg(
        F.count(F.lit(1)).alias("total_prs"),
        merged.alias("merged_prs"),
        round_scaled(merged.cast("double") * 100.0 / F.count(F.lit(1)), 2).alias("merge_rate_pct"))
        .orderBy(F.col("merge_rate_pct").desc_nulls_last()))


def q04_slowest_prs(wh: Warehouse, k: int = 20) -> DataFrame:
    """Top-k first, then enrich: a fact's non-NULL repo / author key always
    has its dimension row (the keys come from those dimensions), so the inner
    joins drop exactly the NULL-key rows; filtering those first makes the
    top k exact before any join. The k rows (a proven bound) are the
    broadcast build side, and the dimensions - the user dimension may be
    large - are streamed past them instead of being shuffled with the facts."""
    f = wh.fct_pull_requests.filter((F.col("is_merged") == True)  # noqa: E712
                                    & F.col("repo_key").isNotNull() & F.col("author_key").isNotNull())
    order = [F.col("time_to_merge_hours").desc_nulls_last(), F.col("pull_request_id").asc()]
    top = broadcast_if_bounded(f.orderBy(*order).limit(k), k)
    r = wh.dim_repositories.select(F.col("repo_key").alias("_rk"), "repository_name")
    u = wh.dim_users.select(F.col("user_key").alias("_uk"), F.col("user_login").alias("author"))
    x = r.join(top, top.repo_key == r._rk).join(u, F.col("author_key") == u._uk)
    return (x.orderBy(*order)
             .select("repository_name", "pr_number", "pr_title", "author", "created_at", "merged_at",
                     round_scaled(F.col("time_to_merge_hours") / 24, 2).alias("days_to_merge")))


def q05_issue_resolution(wh: Warehouse) -> DataFrame:
    f = wh.fct_issues.filter((F.col("is_closed") == True) & F.col("time_to_close_hours").isNotNull())  # noqa: E712
    h = F.col("time_to_close_hours")
    return (_with_repo(f, wh).groupBy("repository_name").agg(
        F.count(F.lit(1)).alias("total_closed_issues"),
        round_scaled(F.avg(h), 2).alias("avg_hours_to_close"),
        round_scaled(F.median(h), 2).alias("median_hours_to_close"),
        round_scaled(F.avg(h) / 24, 2).alias("avg_days_to_close"),
        round_scaled(F.median(h) / 24, 2).alias("median_days_to_close"))
        .orderBy(F.col("median_hours_to_close").asc_nulls_last()))


def q06_bug_vs_enhancement(wh: Warehouse) -> DataFrame:
    bug = F.sum(F.when(F.col("is_bug"), 1).otherwise(0)).cast("bigint")
    enh = F.sum(F.when(F.col("is_enhancement"), 1).otherwise(0)).cast("bigint")
    n = F.count(F.lit(1))
    return _with_repo(wh.fct_issues, wh).groupBy("repository_name").agg(
        n.alias("total_issues"), bug.alias("bug_issues"), enh.alias("enhancement_issues"),
        round_scaled(bug.cast("double") * 100.0 / n, 2).alias("bug_pct"),
        round_scaled(enh.cast("double") * 100.0 / n, 2).alias("enhancement_pct"))


def _named_months(wh: Warehouse) -> DataFrame:
    """Activity months of humans under the login of their dimension row."""
    return wh.human_months.drop("user_login").withColumnRenamed("name", "user_login")


def q07_top_contributors(wh: Warehouse, k: int = 20) -> DataFrame:
    # per repository first, so that repositories are counted without a distinct
    kinds = list(metrics.ACTIVITY_TYPES)
    per_repo = _named_months(wh).groupBy("user_login", "is_bot", "repository_full_name").agg(
        F.sum("n").alias("n"), *[F.sum(f"n_{t}").alias(f"n_{t}") for t in kinds],
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))
    g = per_repo.groupBy("user_login", "is_bot").agg(
        F.sum("n").alias("total_activities"), *[F.sum(f"n_{t}").alias(f"n_{t}") for t in kinds],
        F.count("repository_full_name").alias("repos_contributed_to"),
        F.min("first_at").alias("first_activity"), F.max("last_at").alias("last_activity"))
    return (g.select("user_login", "is_bot", "total_activities", metrics.kinds_of_activity().alias("activity_types"),
                     "repos_contributed_to", "first_activity", "last_activity")
            .orderBy(F.col("total_activities").desc_nulls_last(), F.col("user_login").asc_nulls_last()).limit(k))


def q08_contributor_breakdown(wh: Warehouse, k: int = 20) -> DataFrame:
    g = _named_months(wh).groupBy("user_login").agg(
        *[F.sum(f"n_{t}").alias(f"{t}s") for t in ("commit", "pr", "issue", "comment")], F.sum("n").alias("total_activities"))
    return g.orderBy(F.col("total_activities").desc_nulls_last(), F.col("user_login").asc_nulls_last()).limit(k)


def q09_cumulative_stars(wh: Warehouse) -> DataFrame:
    s = wh.fct_stargazers.filter(F.col("starred_date_key").isNotNull())
    x = _with_repo(s, wh).withColumn("date", F.col("starred_at").cast("date"))
    daily = x.groupBy("date", "repository_name").agg(F.count(F.lit(1)).alias("new_stars"))
    w = Window.partitionBy("repository_name").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (daily.withColumn("cumulative_stars", F.sum("new_stars").over(w))
                 .orderBy(F.col("repository_name").asc_nulls_last(), F.col("date").asc_nulls_last()))


def q10_monthly_pr_activity(wh: Warehouse) -> DataFrame:
    f = wh.fct_pull_requests.filter(F.col("created_date_key").isNotNull())
    d = F.col("created_at").cast("date")
    x = _with_repo(f, wh).withColumn("year", F.year(d)).withColumn("month", F.month(d))
    return (x.groupBy("year", "month", "repository_name").agg(
        F.count(F.lit(1)).alias("prs_created"),
        F.sum(F.when(F.col("is_merged"), 1).otherwise(0)).cast("bigint").alias("prs_merged"),
        round_scaled(F.avg("time_to_merge_hours") / 24, 2).alias("avg_days_to_merge"))
        .orderBy(*[F.col(c).asc_nulls_last() for c in ("year", "month", "repository_name")]))


def q11_cycle_time_trend(wh: Warehouse) -> DataFrame:
    m = metrics.pr_cycle_time(wh.fct_pull_requests, wh.dim_repositories, grains=("monthly",))
    return (m.filter(F.col("period_type") == "monthly")
             .select("repository_name", "period_type", "year", "period_number", "merged_pr_count",
                     "median_days_to_merge", "p90_days_to_merge")
             .orderBy(*[F.col(c).asc_nulls_last() for c in ("repository_name", "year", "period_number")]))


def q12_engagement_trend(wh: Warehouse) -> DataFrame:
    e = wh.contributor_engagement
    return (e.select("repository_full_name", "year", "month", "unique_contributors", "new_contributors",
                     "returning_contributors", round_scaled("returning_contributor_pct", 2).alias("returning_pct"),
                     "total_activities", round_scaled("activities_per_contributor", 2).alias("activities_per_contributor"))
             .orderBy(*[F.col(c).asc_nulls_last() for c in ("repository_full_name", "year", "month")]))


def q13_release_velocity(wh: Warehouse) -> DataFrame:
    r = metrics.release_velocity(wh.stg_releases, wh.dim_repositories, grains=("monthly",))
    return (r.filter(F.col("period_type") == "monthly")
             .select("repository_name", "period_type", "year", "period_number", "release_count",
                     "stable_release_count",
                     round_scaled("avg_days_between_releases", 1).alias("avg_days_between_releases"),
                     round_scaled("median_days_between_releases", 1).alias("median_days_between_releases"))
             .orderBy(*[F.col(c).asc_nulls_last() for c in ("repository_name", "year", "period_number")]))


def q14_contributor_retention(wh: Warehouse) -> DataFrame:
    um = metrics.user_month_activity(wh.human_months)
    g = um.groupBy("repository_full_name", "activity_month").agg(
        F.count(F.lit(1)).alias("active_contributors"),
        F.count_if(F.col("first_month") == F.col("activity_month")).alias("new_contributors"),
        F.count_if(F.col("first_month") < F.col("activity_month")).alias("returning_contributors"))
    return g.orderBy(F.col("repository_full_name").asc_nulls_last(), F.col("activity_month").asc_nulls_last())


def q15_first_comment_responsiveness(wh: Warehouse) -> DataFrame:
    h = F.col("time_to_first_comment_hours")
    f = wh.fct_pull_requests.filter(h.isNotNull())
    return (_with_repo(f, wh).groupBy("repository_name").agg(
        F.count(F.lit(1)).alias("total_prs"),
        F.count(F.when(h.isNotNull(), 1)).alias("prs_with_comments"),
        round_scaled(F.avg(h), 2).alias("avg_hours_to_first_comment"),
        round_scaled(F.median(h), 2).alias("median_hours_to_first_comment"),
        round_scaled(F.avg(h) / 24, 2).alias("avg_days_to_first_comment"))
        .orderBy(F.col("median_hours_to_first_comment").asc_nulls_last()))


QUERIES = {
    "q01_repository_stats": q01_repository_stats,
    "q02_pr_cycle_time_by_repo": q02_pr_cycle_time_by_repo,
    "q03_pr_merge_rate": q03_pr_merge_rate,
    "q04_slowest_prs": q04_slowest_prs,
    "q05_issue_resolution": q05_issue_resolution,
    "q06_bug_vs_enhancement": q06_bug_vs_enhancement,
    "q07_top_contributors": q07_top_contributors,
    "q08_contributor_breakdown": q08_contributor_breakdown,
    "q09_cumulative_stars": q09_cumulative_stars,
    "q10_monthly_pr_activity": q10_monthly_pr_activity,
    "q11_cycle_time_trend": q11_cycle_time_trend,
    "q12_engagement_trend": q12_engagement_trend,
    "q13_release_velocity": q13_release_velocity,
    "q14_contributor_retention": q14_contributor_retention,
    "q15_first_comment_responsiveness": q15_first_comment_responsiveness,
}
