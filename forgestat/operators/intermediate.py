"""Intermediate models (M-13 ... M-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from forgestat.functions.time import hour_boundaries, trunc_ntz

ACTIVITY_COLUMNS = ["user_id", "user_login", "repository_full_name", "activity_type",
                    "activity_at", "activity_id"]


def comment_stats(stg_comments: DataFrame) -> DataFrame:
    """(repo, issue number) -> comment count and first comment (A-03); shared
    by the issue and PR lifecycles. Partial aggregation before the shuffle."""
    return stg_comments.groupBy("repository_full_name", "issue_number").agg(
        F.count(F.lit(1)).alias("comment_count"), F.min("created_at").alias("first_comment_at"))


# Activities above which a user's flag is broadcast instead of joined by shuffle.
HEAVY_ROWS = 1_000_000


def activity_rows(stg_issues: DataFrame, stg_prs: DataFrame, stg_comments: DataFrame,
                  stg_commits: DataFrame) -> DataFrame:
    """One row per activity (issue, PR, comment, commit) that has an author."""
    def src(df, kind, at, act_id):
        return df.filter(F.col("author_id").isNotNull()).select(
            F.col("author_id").alias("user_id"), F.col("author_login").alias("user_login"),
            "repository_full_name", F.lit(kind).alias("activity_type"),
            F.col(at).alias("activity_at"), F.col(act_id).cast("string").alias("activity_id"))

    return (src(stg_issues, "issue_created", "created_at", "issue_id")
            .unionByName(src(stg_prs, "pr_created", "created_at", "pull_request_id"))
            .unionByName(src(stg_comments, "comment_created", "created_at", "comment_id"))
            .unionByName(src(stg_commits, "commit_created", "commit_date", "commit_sha")))


def with_bot_flag(act: DataFrame, users: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``act`` with its user's ``is_bot`` (a left join, NULL without a user).

    Users with more than ``heavy_rows`` activities - by counting, at most
    rows / heavy_rows of them, a bound that makes their flags small enough to
    broadcast - never meet in one shuffle partition: their activities take the
    flag from the broadcast and go through the join of all others under a key
    of their own, spread by activity, that is not looked at again."""
    counted = act.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > heavy_rows)
    heavy = users.join(counted, "user_id").select(F.col("user_id").alias("_h_id"), F.col("is_bot").alias("_h_bot"))
    spread = F.xxhash64("activity_type", "activity_id")
    x = act.join(F.broadcast(heavy), act.user_id == heavy._h_id, "left").withColumn(
        "_key", F.when(F.col("_h_id").isNull(), F.col("user_id")).otherwise(spread))
    u = users.select(F.col("user_id").alias("_u_id"), F.col("is_bot").alias("_u_bot"))
    x = x.join(u, x._key == u._u_id, "left")
    return x.withColumn("is_bot", F.when(F.col("_h_id").isNotNull(), F.col("_h_bot")).otherwise(F.col("_u_bot"))).drop(
        "_h_id", "_h_bot", "_key", "_u_id", "_u_bot")


def int_contributor_activity(act: DataFrame, users: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``activity_rows`` with the author's bot flag and day / week / month / year
    truncations (timestamp_ntz)."""
    a = with_bot_flag(act, users, heavy_rows)
    return a.select(*ACTIVITY_COLUMNS, "is_bot",
                    trunc_ntz("day", "activity_at").alias("activity_date"),
                    trunc_ntz("week", "activity_at").alias("activity_week"),
                    trunc_ntz("month", "activity_at").alias("activity_month"),
                    trunc_ntz("year", "activity_at").alias("activity_year"))


def int_issue_lifecycle(stg_issues: DataFrame, stg_issue_labels: DataFrame,
                        comments: DataFrame) -> DataFrame:
    """Issue with comment stats, label flags and close / first-response hours
    (hour boundaries, SURVEY P1). ``comments`` is :func:`comment_stats`."""
    low = F.lower(F.col("label_name"))
    labels = stg_issue_labels.groupBy("issue_dlt_id").agg(
        F.count(F.lit(1)).alias("label_count"),
        F.max(F.when(low == "bug", 1).otherwise(0)).alias("has_bug_label"),
        F.max(F.when(low.isin("enhancement", "feature"), 1).otherwise(0)).alias("has_enhancement_label"))
    i = stg_issues.alias("i")
    c = comments.alias("c")
    l = labels.alias("l")
    # labels first: their key, a hash that does not compress, is not moved again
    j = (i.join(l, F.col("i.issue_dlt_id") == F.col("l.issue_dlt_id"), "left")
          .join(c, (F.col("i.repository_full_name") == F.col("c.repository_full_name"))
                & (F.col("i.issue_number") == F.col("c.issue_number")), "left"))
    return j.select(
        "i.issue_id", "i.issue_number", "i.repository_full_name", "i.issue_title", "i.issue_state",
        "i.author_login", "i.author_id", "i.created_at", "i.updated_at", "i.closed_at",
        F.coalesce(F.col("c.comment_count"), F.lit(0)).alias("comment_count"),
        F.col("c.first_comment_at"),
        hour_boundaries("i.created_at", "i.closed_at").alias("time_to_close_hours"),
        hour_boundaries("i.created_at", "c.first_comment_at").alias("time_to_first_response_hours"),
        F.col("i.closed_at").isNotNull().alias("is_closed"),
        F.col("i.assignee_id").isNotNull().alias("is_assigned"),
        F.coalesce(F.col("l.label_count"), F.lit(0)).alias("label_count"),
        F.coalesce(F.col("l.has_bug_label") == 1, F.lit(False)).alias("is_bug"),
        F.coalesce(F.col("l.has_enhancement_label") == 1, F.lit(False)).alias("is_enhancement"),
    )


REVIEW_COLUMNS = ["repository_owner", "repository_name", "pull_request_number", "reviewer_user_id", "submitted_at", "review_state"]


def review_stats(stg_pr_reviews: DataFrame) -> DataFrame:
    """Review roll-up per PR (A-05); only used when reviews are landed."""
    st = F.col("review_state")
    return stg_pr_reviews.groupBy("repository_owner", "repository_name", "pull_request_number").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.countDistinct("reviewer_user_id").alias("unique_reviewers"),
        F.min("submitted_at").alias("first_review_at"),
        F.max("submitted_at").alias("last_review_at"),
        F.count_if(st == "APPROVED").alias("approval_count"),
        F.count_if(st == "CHANGES_REQUESTED").alias("changes_requested_count"),
        F.count_if(st == "COMMENTED").alias("comment_review_count"))


PR_COLUMNS = ["pull_request_id", "pr_number", "repository_owner", "repository_name", "repository_full_name", "pr_title",
              "pr_state", "is_merged", "is_draft", "author_login", "author_id", "created_at", "updated_at", "closed_at", "merged_at"]


def labelled_prs(stg_prs: DataFrame, stg_pr_labels: DataFrame) -> DataFrame:
    """The pull requests' columns that :func:`int_pr_with_reviews` takes, with their number
    of labels (NULL: none). Joined first, as the labels' key is a hash that does not
    compress: so it is not moved again."""
    labels = stg_pr_labels.groupBy(F.col("pr_dlt_id").alias("_l_id")).agg(F.count(F.lit(1)).alias("label_count"))
    return stg_prs.join(labels, stg_prs.pr_dlt_id == labels._l_id, "left").select(*PR_COLUMNS, "label_count")


def int_pr_with_reviews(prs: DataFrame, comments: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """PR (:func:`labelled_prs`) with review, comment and label stats, four durations and
    status flags. Without landed reviews (the reference's state) the review columns
    are typed constants and no join is planned."""
    p = prs.alias("p")
    c = comments.alias("c")
    j = p
    if reviews is not None:
        r = reviews.alias("r")
        j = j.join(r, (F.col("p.repository_owner") == F.col("r.repository_owner"))
                   & (F.col("p.repository_name") == F.col("r.repository_name"))
                   & (F.col("p.pr_number") == F.col("r.pull_request_number")), "left")
        rv = {k: F.col(f"r.{k}") for k in ("review_count", "unique_reviewers", "first_review_at",
                                            "last_review_at", "approval_count", "changes_requested_count",
                                            "comment_review_count")}
    else:
        zero, nts = F.lit(None).cast("bigint"), F.lit(None).cast("timestamp_ntz")
        rv = {"review_count": zero, "unique_reviewers": zero, "first_review_at": nts,
              "last_review_at": nts, "approval_count": zero, "changes_requested_count": zero,
              "comment_review_count": zero}
    j = j.join(c, (F.col("p.repository_full_name") == F.col("c.repository_full_name"))
               & (F.col("p.pr_number") == F.col("c.issue_number")), "left")
    closed_unmerged = F.col("p.closed_at").isNotNull() & F.col("p.merged_at").isNull()
    return j.select(
        "p.pull_request_id", "p.pr_number", "p.repository_full_name", "p.pr_title", "p.pr_state",
        "p.is_merged", "p.is_draft", "p.author_login", "p.author_id", "p.created_at", "p.updated_at",
        "p.closed_at", "p.merged_at",
        F.coalesce(rv["review_count"], F.lit(0).cast("bigint")).alias("review_count"),
        F.coalesce(rv["unique_reviewers"], F.lit(0).cast("bigint")).alias("unique_reviewers"),
        rv["first_review_at"].alias("first_review_at"),
        rv["last_review_at"].alias("last_review_at"),
        F.coalesce(rv["approval_count"], F.lit(0).cast("bigint")).alias("approval_count"),
        F.coalesce(rv["changes_requested_count"], F.lit(0).cast("bigint")).alias("changes_requested_count"),
        F.coalesce(rv["comment_review_count"], F.lit(0).cast("bigint")).alias("comment_review_count"),
        F.coalesce(F.col("c.comment_count"), F.lit(0)).alias("comment_count"),
        F.col("c.first_comment_at"),
        hour_boundaries("p.created_at", rv["first_review_at"]).alias("time_to_first_review_hours"),
        hour_boundaries("p.created_at", "c.first_comment_at").alias("time_to_first_comment_hours"),
        hour_boundaries("p.created_at", "p.merged_at").alias("time_to_merge_hours"),
        F.when(closed_unmerged, hour_boundaries("p.created_at", "p.closed_at")).alias("time_to_close_without_merge_hours"),
        F.col("p.closed_at").isNotNull().alias("is_closed"),
        F.coalesce(closed_unmerged, F.lit(False)).alias("is_closed_without_merge"),
        F.coalesce(F.col("p.label_count"), F.lit(0)).alias("label_count"),
    )
