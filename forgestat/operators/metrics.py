"""Metric models (M-23 ... M-27).

Plan shapes chosen for scale (SURVEY 4):
* pr_cycle_time / release_velocity aggregate both period grains in ONE pass:
  each input row is exploded into its two period keys (x2 rows, one
  shuffle), instead of scanning the inlined fact chain twice;
* contributor metrics start from one table, ``user_months``: activity by (repo,
  user, month), aggregated before it meets the users; (repo, month) sums of
  per-user flags need no ``count(distinct)`` Expand (x8 rows), and the
  first-activity month is a window over the already aggregated rows;
* release gaps: ``lag`` per repository is computed over DISTINCT timestamps,
  in blocks of minutes whose first rows carry the link to the block before,
  so a hot repository or day is never sorted in one task, and tied releases are weighted
  rows (exact percentile with a frequency) instead of repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from forgestat.functions.time import day_boundaries, trunc_ntz
from forgestat.functions.users import is_bot_login

# Fixed value: percentiles of the reference's cycle-time report.
CYCLE_PERCENTILES = (25, 75, 90)
# Release instants of a repository within these minutes are sorted together.
BLOCK_MINUTES = 10
ACTIVITY_TYPES = {"commit": "commit_created", "pr": "pr_created", "issue": "issue_created",
                  "comment": "comment_created"}


def pr_cycle_time(fct_prs: DataFrame, dim_repos: DataFrame,
                  grains: tuple[str, ...] = ("weekly", "monthly"),
                  monday_week_start: bool = False, iso_year: bool = False) -> DataFrame:
    """Merge-time statistics per repository and week / month, all exact.

    Rows are counted by (group, hour) first; medians and quantiles are ranks in
    the running counts, so that a window holds at most a group's distinct hours
    (a calendar's worth), however many rows the group has.

    Defaults follow the reference SQL: the weekly key is (calendar year, ISO
    week) and the period start is the first PR date in the group (SURVEY D8,
    D9). ``iso_year`` keys weeks by their ISO year (so 2026-12-31 falls in
    week 53 of 2026 and 2027-01-01 ... too); ``monday_week_start`` reports the
    Monday of the week as the weekly period start."""
    ttm = F.col("time_to_merge_hours")
    f = fct_prs.filter((F.col("is_merged") == True) & ttm.isNotNull() & (ttm >= 0)  # noqa: E712
                       & F.col("created_date_key").isNotNull())
    r = dim_repos.select(F.col("repo_key").alias("_rk"), "repository_name", "repository_full_name")
    x = f.join(r, f.repo_key == r._rk)
    d = F.col("created_at").cast("date")
    by_grain = {
        "weekly": F.struct(F.lit("weekly").alias("period_type"), F.weekofyear(d).alias("period_number")),
        "monthly": F.struct(F.lit("monthly").alias("period_type"), F.month(d).alias("period_number"))}
    periods = F.array(*[by_grain[g] for g in grains])
    dd = F.col("date")
    week_year = F.year(F.date_add(F.date_trunc("week", dd).cast("date"), 3)) if iso_year else F.year(dd)
    x = x.select("repository_name", "repository_full_name", d.alias("date"), ttm.alias("h"),
                 F.explode(periods).alias("p"))
    x = x.withColumn("year", F.when(F.col("p.period_type") == "weekly", week_year.cast("int"))
                     .otherwise(F.year("date")))
    group = ["period_type", "repository_name", "repository_full_name", "year", "period_number"]
    hist = x.groupBy(F.col("p.period_type").alias("period_type"), "repository_name", "repository_full_name",
                     "year", F.col("p.period_number").alias("period_number"), "h").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first"))
    whole = Window.partitionBy(*group)
    upto = F.sum("n").over(whole.orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hist = hist.withColumn("upto", upto).withColumn("total", F.sum("n").over(whole))

    def at(rank: Column) -> Column:
        """The value of this rank (from 1): in the first row that reaches it."""
        return F.max(F.when((F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank), F.col("h")))
    total = F.col("total")
    g = hist.groupBy(*group).agg(
        F.min("first").alias("period_start_date"),
        F.sum("n").alias("merged_pr_count"),
        (F.sum(F.col("n") * F.col("h")).cast("double") / F.sum("n")).alias("avg_hours_to_merge"),
        ((at(F.expr("(total + 1) div 2")) + at(F.expr("total div 2 + 1"))) / F.lit(2.0)).alias("median_hours_to_merge"),
        F.min("h").alias("min_hours_to_merge"),
        F.max("h").alias("max_hours_to_merge"),
        F.array(*[at(F.ceil(total * q / 100).cast("long")) for q in CYCLE_PERCENTILES]).alias("q"))
    if monday_week_start:
        g = g.withColumn("period_start_date", F.when(
            F.col("period_type") == "weekly", F.date_trunc("week", "period_start_date").cast("date"))
            .otherwise(F.col("period_start_date")))
    return g.select(
        "period_type", "repository_name", "repository_full_name", "year", "period_number",
        "period_start_date", "merged_pr_count", "avg_hours_to_merge", "median_hours_to_merge",
        "min_hours_to_merge", "max_hours_to_merge",
        F.col("q")[0].alias("p25_hours_to_merge"), F.col("q")[1].alias("p75_hours_to_merge"),
        F.col("q")[2].alias("p90_hours_to_merge"),
        (F.col("avg_hours_to_merge") / 24).alias("avg_days_to_merge"),
        (F.col("median_hours_to_merge") / 24).alias("median_days_to_merge"),
        (F.col("q")[2] / 24).alias("p90_days_to_merge"))


def user_months(activity: DataFrame, more_logins: DataFrame | None = None) -> DataFrame:
    """Activity of all users by (repository, user, login, month): counts in all and
    by type, first and last instant; with each user's smallest login (``name``) and
    bot flag, as the user dimension has them.

    The logins of ``more_logins`` (users of sources that are no activity) travel as
    rows without activity, so that one aggregation and one window by user give
    the flags without building the dimension or joining it. A user with a third
    of all activities is as many rows as it has repositories and months."""
    t = F.col("activity_type")
    rows = activity.select("repository_full_name", "user_id", "user_login", trunc_ntz("month", "activity_at").alias("activity_month"),
                           "activity_type", "activity_at")
    if more_logins is not None:
        rows = rows.unionByName(more_logins, allowMissingColumns=True)
    months = rows.groupBy("repository_full_name", "user_id", "user_login", "activity_month").agg(
        F.count("activity_type").alias("n"), *[F.count_if(t == v).alias(f"n_{k}") for k, v in ACTIVITY_TYPES.items()],
        F.min("activity_at").alias("first_at"), F.max("activity_at").alias("last_at"))
    months = months.withColumn("name", F.min("user_login").over(Window.partitionBy("user_id")))
    return months.withColumn("is_bot", is_bot_login("name")).filter(F.col("n") > 0)


def human_months(months: DataFrame) -> DataFrame:
    """The months of users that are no bots (NULL dropped, as in SQL)."""
    return months.filter(F.col("is_bot") == False)  # noqa: E712


def user_month_activity(months: DataFrame) -> DataFrame:
    """(repo, user, month) with per-type counts and the user's first month in the
    repository (new vs returning)."""
    um = months.groupBy("repository_full_name", "user_id", "activity_month").agg(
        *[F.sum(c).alias(c) for c in ("n", *[f"n_{k}" for k in ACTIVITY_TYPES])])
    first = F.min("activity_month").over(Window.partitionBy("repository_full_name", "user_id"))
    return um.withColumn("first_month", first).withColumn(
        "is_new", F.coalesce(F.col("activity_month") == F.col("first_month"), F.lit(False)))


def contributor_engagement(months: DataFrame) -> DataFrame:
    """``months``: :func:`human_months`."""
    um = user_month_activity(months)
    g = um.groupBy("repository_full_name", "activity_month").agg(
        F.count(F.lit(1)).alias("unique_contributors"),
        F.sum("n").alias("total_activities"),
        F.count_if(F.col("is_new")).alias("new_contributors"),
        F.count_if(~F.col("is_new")).alias("returning_contributors"),
        F.count_if(F.col("n_commit") > 0).alias("committers"),
        F.count_if(F.col("n_pr") > 0).alias("pr_creators"),
        F.count_if(F.col("n_issue") > 0).alias("issue_creators"),
        F.count_if(F.col("n_comment") > 0).alias("commenters"),
        F.sum("n_commit").alias("commit_count"),
        F.sum("n_pr").alias("pr_count"),
        F.sum("n_issue").alias("issue_count"),
        F.sum("n_comment").alias("comment_count"))
    uc = F.col("unique_contributors")
    return g.select(
        "repository_full_name",
        trunc_ntz("year", "activity_month").alias("year"),
        F.month("activity_month").alias("month"),
        F.col("activity_month").alias("month_start_date"),
        "unique_contributors", "total_activities", "new_contributors", "returning_contributors",
        "committers", "pr_creators", "issue_creators", "commenters",
        "commit_count", "pr_count", "issue_count", "comment_count",
        (F.col("total_activities").cast("double") / uc).alias("activities_per_contributor"),
        (F.col("returning_contributors").cast("double") * 100.0 / F.nullif(uc, F.lit(0))).alias("returning_contributor_pct"))


def kinds_of_activity() -> Column:
    """Number of activity types with a count above 0."""
    return sum((F.when(F.col(f"n_{k}") > 0, 1).otherwise(0) for k in ACTIVITY_TYPES), F.lit(0)).cast("bigint")


def top_contributors(months: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` users per repository-month by activity (M-25, dead CTE in the
    reference). Ties broken by user id. Catalyst inserts a per-partition
    window group limit before the shuffle, so a hot repo-month sends at most
    ``k`` rows per map task. ``months``: :func:`human_months`."""
    w = Window.partitionBy("repository_full_name", "activity_month").orderBy(
        F.col("n").desc(), F.col("user_id").asc(), F.col("user_login").asc_nulls_last())
    return (months.withColumn("contributor_rank", F.row_number().over(w).cast("bigint"))
            .filter(F.col("contributor_rank") <= k)
            .select("repository_full_name", trunc_ntz("year", "activity_month").alias("year"),
                    F.month("activity_month").alias("month"), "user_login", "user_id",
                    F.col("n").alias("activity_count"), kinds_of_activity().alias("activity_type_count"), "contributor_rank"))


def release_gaps(stg_releases: DataFrame, dim_repos: DataFrame) -> DataFrame:
    """Distinct release instants per repository with their counts and the
    day gap to the previous distinct instant (``gap_first``). Equivalent to
    the reference's row ``lag``: of k releases at one instant, one gets
    ``gap_first`` and k-1 get 0, whatever the tie order."""
    rel = stg_releases.filter((F.col("is_draft") == False) & F.col("published_at").isNotNull())  # noqa: E712
    r = dim_repos.select(F.col("repository_full_name").alias("_rf"), F.col("repository_name").alias("_rn"))
    rel = rel.join(r, rel.repository_full_name == r._rf)
    pre = F.col("is_prerelease")
    inst = rel.groupBy(F.col("_rf").alias("repository_full_name"), "published_at").agg(
        F.max("_rn").alias("repository_name"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(pre == False).alias("n_stable"),  # noqa: E712
        F.count_if(pre == True).alias("n_pre"))  # noqa: E712
    # blocks of BLOCK_MINUTES: lag within a block; a block's first instant follows the
    # last one of the block before, found among the blocks' first rows
    inst = inst.withColumn("block", F.expr(f"unix_micros(cast(published_at as timestamp)) div {BLOCK_MINUTES * 60_000_000}"))
    block = Window.partitionBy("repository_full_name", "block")
    inst = (inst.withColumn("prev", F.lag("published_at").over(block.orderBy("published_at")))
            .withColumn("last", F.max("published_at").over(block)))
    # the blocks' first rows are one chain per repository, all others stay in their blocks
    chain = Window.partitionBy("repository_full_name", F.col("prev").isNull(), F.when(F.col("prev").isNotNull(), F.col("block")))
    x = inst.withColumn("prev", F.coalesce("prev", F.lag("last").over(chain.orderBy("published_at"))))
    return x.select("repository_full_name", "repository_name", "published_at", "n", "n_stable", "n_pre",
                    F.col("prev").alias("prev_at"), day_boundaries("prev", "published_at").alias("gap_first"))


def release_intervals(stg_releases: DataFrame, dim_repos: DataFrame) -> DataFrame:
    """Row-level releases with the previous release instant of the
    repository and the day gap (W-01, W-02). Built from the distinct-instant
    gaps: of k releases at one instant the one with the lowest id gets the
    previous distinct instant, the others the instant itself (gap 0) - the
    result of ``lag`` ordered by (published_at, release_id). The instant's
    lowest id and count are a hash aggregation joined back on (repo, instant),
    so no window ever holds a whole repository or instant."""
    rel = stg_releases.filter((F.col("is_draft") == False) & F.col("published_at").isNotNull())  # noqa: E712
    r = dim_repos.select(F.col("repository_full_name").alias("_rf"), F.col("repository_name").alias("_rn"))
    rel = rel.join(r, rel.repository_full_name == r._rf).drop("_rf")
    g = release_gaps(stg_releases, dim_repos).select(
        F.col("repository_full_name").alias("_gf"), F.col("published_at").alias("_gt"), "gap_first", "prev_at")
    first_id = rel.groupBy(F.col("repository_full_name").alias("_ff"), F.col("published_at").alias("_ft")).agg(
        F.min("release_id").alias("_first_id"))
    x = (rel.join(g, (rel.repository_full_name == g._gf) & (rel.published_at == g._gt))
            .join(first_id, (rel.repository_full_name == first_id._ff) & (rel.published_at == first_id._ft)))
    first = F.col("release_id") == F.col("_first_id")
    return x.select(
        "repository_full_name", F.col("_rn").alias("repository_name"), "release_id", "tag_name", "release_name",
        "is_prerelease", "is_draft", "published_at", "created_at",
        F.when(first, F.col("prev_at")).otherwise(F.col("published_at")).alias("previous_release_at"),
        F.when(first, F.col("gap_first")).otherwise(F.lit(0).cast("bigint")).alias("days_since_last_release"))


def release_velocity(stg_releases: DataFrame, dim_repos: DataFrame,
                     grains: tuple[str, ...] = ("monthly", "quarterly")) -> DataFrame:
    g = release_gaps(stg_releases, dim_repos)
    ts = F.col("published_at")
    y, q = F.year(ts), F.quarter(ts)
    by_grain = {
        "monthly": F.struct(F.lit("monthly").alias("period_type"), F.month(ts).alias("period_number"),
                            F.lit(None).cast("int").alias("quarter"), trunc_ntz("month", ts).alias("start")),
        "quarterly": F.struct(F.lit("quarterly").alias("period_type"), F.lit(None).cast("int").alias("period_number"),
                              q.alias("quarter"),
                              F.make_date(y, q * 3 - 2, F.lit(1)).cast("timestamp_ntz").alias("start"))}
    periods = F.array(*[by_grain[g] for g in grains])
    # gap entries: (gap_first, weight 1, counts) and (0, weight n-1, no counts)
    entries = F.array(
        F.struct(F.col("gap_first").alias("gap"), F.lit(1).cast("bigint").alias("w"),
                 F.col("n").alias("c"), F.col("n_stable").alias("cs"), F.col("n_pre").alias("cp")),
        F.struct(F.lit(0).cast("bigint").alias("gap"), (F.col("n") - 1).alias("w"),
                 F.lit(0).cast("bigint").alias("c"), F.lit(0).cast("bigint").alias("cs"),
                 F.lit(0).cast("bigint").alias("cp")))
    x = (g.select("repository_full_name", "repository_name", y.alias("year"),
                  F.explode(periods).alias("p"), entries.alias("e"))
          .select("*", F.explode("e").alias("x")).drop("e")
          .filter((F.col("x.w") > 0) | (F.col("x.c") > 0)))
    gap, w = F.col("x.gap"), F.col("x.w")
    live = gap.isNotNull() & (w > 0)
    agg = x.groupBy(F.col("p.period_type").alias("period_type"), "repository_name", "repository_full_name",
                    "year", F.col("p.period_number").alias("period_number"), F.col("p.quarter").alias("quarter"),
                    F.col("p.start").alias("period_start_date")).agg(
        F.sum("x.c").alias("release_count"),
        F.sum("x.cs").alias("stable_release_count"),
        F.sum("x.cp").alias("prerelease_count"),
        (F.sum(F.when(live, gap * w)).cast("double") / F.sum(F.when(live, w))).alias("avg_days_between_releases"),
        F.percentile(F.when(live, gap), F.lit(0.5), F.when(live, w).otherwise(F.lit(1))).alias("median_days_between_releases"),
        F.min(F.when(live, gap)).alias("min_days_between_releases"),
        F.max(F.when(live, gap)).alias("max_days_between_releases"))
    monthly = F.col("period_type") == "monthly"
    return agg.select(
        "period_type", "repository_name", "repository_full_name", "year", "period_number", "quarter",
        "period_start_date", "release_count", "stable_release_count",
        F.when(monthly, F.col("prerelease_count")).alias("prerelease_count"),
        "avg_days_between_releases", "median_days_between_releases",
        F.when(monthly, F.col("min_days_between_releases")).alias("min_days_between_releases"),
        F.when(monthly, F.col("max_days_between_releases")).alias("max_days_between_releases"),
        F.when(monthly, F.col("release_count").cast("double"))
         .otherwise(F.col("release_count").cast("double") / 3).alias("releases_per_period"))


def commits_per_release(stg_commits: DataFrame) -> DataFrame:
    """Commits per repository-month (M-27, dead CTE in the reference)."""
    return stg_commits.groupBy("repository_full_name", trunc_ntz("month", "commit_date").alias("commit_month")).agg(
        F.count(F.lit(1)).alias("commit_count"))
