"""Staging models (M-01 ... M-12): rename, cast, derive; one select each.

Timestamps are cast to ``timestamp_ntz`` (wall clock, SURVEY P13) so ISO text
from landed JSON and typed bronze columns give the same result. Audit columns
(``_loaded_at``) are added only when a model is written (plans.warehouse).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from forgestat.functions.keys import surrogate_key
from forgestat.functions.users import is_bot_login

# Fixed value: pattern that takes the issue number from a comment's issue URL.
ISSUE_URL_NUMBER = r"/issues/(\d+)$"


def _ts(c: str) -> Column:
    return F.col(c).cast("timestamp_ntz")


def _full_name() -> Column:
    # `||` semantics: NULL when either side is NULL
    return F.concat(F.col("_owner"), F.lit("/"), F.col("_repo"))


def stg_repositories(repositories: DataFrame) -> DataFrame:
    r = repositories
    return r.select(
        F.col("id").alias("repository_id"),
        F.col("node_id").alias("repository_node_id"),
        F.col("_row_id").alias("repository_dlt_id"),
        F.col("owner__login").alias("owner_login"),
        F.col("owner__id").alias("owner_id"),
        F.col("name").alias("repository_name"),
        F.col("full_name").alias("repository_full_name"),
        F.col("description").alias("repository_description"),
        F.col("private").alias("is_private"),
        F.col("archived").alias("is_archived"),
        F.col("disabled").alias("is_disabled"),
        F.col("html_url").alias("repository_url"),
        _ts("created_at").alias("created_at"),
        _ts("updated_at").alias("updated_at"),
        _ts("pushed_at").alias("pushed_at"),
        F.col("size").alias("repository_size_kb"),
        "stargazers_count", "watchers_count", "forks_count", "open_issues_count",
        F.col("language").alias("primary_language"),
        "default_branch",
        F.col("license__name").alias("license_name"),
        "has_issues", "has_projects", "has_wiki", "has_pages", "has_downloads",
    )


def stg_issues(issues: DataFrame, exclude_pull_requests: bool = False) -> DataFrame:
    i = issues
    if exclude_pull_requests and "pull_request__url" in i.columns:
        # Documented intent; the reference SQL keeps PRs.
        i = i.filter(F.col("pull_request__url").isNull())
    return i.select(
        F.col("id").alias("issue_id"),
        F.col("node_id").alias("issue_node_id"),
        F.col("_row_id").alias("issue_dlt_id"),
        F.col("number").cast("bigint").alias("issue_number"),
        _full_name().alias("repository_full_name"),
        F.col("title").alias("issue_title"),
        F.col("body").alias("issue_body"),
        F.col("state").alias("issue_state"),
        F.col("locked").alias("is_locked"),
        F.col("user__login").alias("author_login"),
        F.col("user__id").alias("author_id"),
        F.col("assignee__login").alias("assignee_login"),
        F.col("assignee__id").alias("assignee_id"),
        F.col("comments").alias("comments_count"),
        _ts("created_at").alias("created_at"),
        _ts("updated_at").alias("updated_at"),
        _ts("closed_at").alias("closed_at"),
    )


def stg_pull_requests(pull_requests: DataFrame) -> DataFrame:
    p = pull_requests
    return p.select(
        F.col("id").alias("pull_request_id"),
        F.col("node_id").alias("pull_request_node_id"),
        F.col("_row_id").alias("pr_dlt_id"),
        F.col("number").cast("bigint").alias("pr_number"),
        F.col("_owner").alias("repository_owner"),
        F.col("_repo").alias("repository_name"),
        _full_name().alias("repository_full_name"),
        F.col("title").alias("pr_title"),
        F.col("body").alias("pr_body"),
        F.col("state").alias("pr_state"),
        F.col("locked").alias("is_locked"),
        F.col("draft").alias("is_draft"),
        F.col("user__login").alias("author_login"),
        F.col("user__id").alias("author_id"),
        F.col("assignee__login").alias("assignee_login"),
        F.col("assignee__id").alias("assignee_id"),
        F.col("head__ref").alias("head_ref"),
        F.col("head__sha").alias("head_sha"),
        F.col("base__ref").alias("base_ref"),
        F.col("base__sha").alias("base_sha"),
        "merge_commit_sha",
        F.col("merged_at").isNotNull().alias("is_merged"),
        _ts("created_at").alias("created_at"),
        _ts("updated_at").alias("updated_at"),
        _ts("closed_at").alias("closed_at"),
        _ts("merged_at").alias("merged_at"),
    )


def stg_issue_comments(issue_comments: DataFrame, strict: bool = True) -> DataFrame:
    """``strict`` keeps the reference's failing cast on a URL without a number
    (SURVEY P12); ``strict=False`` yields NULL instead."""
    c = issue_comments
    num = F.regexp_extract(F.col("issue_url"), ISSUE_URL_NUMBER, 1)
    num = num.cast("bigint") if strict else num.try_cast("bigint")
    return c.select(
        F.col("id").alias("comment_id"),
        F.col("node_id").alias("comment_node_id"),
        num.alias("issue_number"),
        _full_name().alias("repository_full_name"),
        F.col("body").alias("comment_body"),
        F.length(F.col("body")).cast("bigint").alias("comment_length"),
        F.col("user__login").alias("author_login"),
        F.col("user__id").alias("author_id"),
        _ts("created_at").alias("created_at"),
        _ts("updated_at").alias("updated_at"),
    )


def stg_commits(commits: DataFrame) -> DataFrame:
    c = commits
    return c.select(
        F.col("sha").alias("commit_sha"),
        F.col("node_id").alias("commit_node_id"),
        _full_name().alias("repository_full_name"),
        F.col("author__login").alias("author_login"),
        F.col("author__id").alias("author_id"),
        F.col("committer__login").alias("committer_login"),
        F.col("committer__id").alias("committer_id"),
        F.col("commit__author__name").alias("commit_author_name"),
        F.col("commit__author__email").alias("commit_author_email"),
        F.col("commit__committer__name").alias("committer_name"),
        F.col("commit__committer__email").alias("committer_email"),
        F.col("commit__message").alias("commit_message"),
        F.length(F.col("commit__message")).cast("bigint").alias("message_length"),
        F.col("commit__tree__sha").alias("tree_sha"),
        F.col("commit__comment_count").alias("comment_count"),
        _ts("commit__author__date").alias("commit_date"),
        _ts("commit__committer__date").alias("committer_date"),
    )


def stg_releases(releases: DataFrame) -> DataFrame:
    r = releases
    return r.select(
        F.col("id").alias("release_id"),
        surrogate_key("_owner", "_repo").alias("repository_key"),
        F.col("author__id").alias("author_user_id"),
        F.col("_owner").alias("repository_owner"),
        F.col("_repo").alias("repository_name"),
        _full_name().alias("repository_full_name"),
        "tag_name", "target_commitish",
        F.col("name").alias("release_name"),
        F.col("draft").alias("is_draft"),
        F.col("prerelease").alias("is_prerelease"),
        F.col("body").alias("release_notes"),
        _ts("created_at").alias("created_at"),
        _ts("published_at").alias("published_at"),
        F.col("_load_id").alias("_dlt_load_id"),
        F.col("_row_id").alias("_dlt_id"),
    )


def stg_stargazers(stargazers: DataFrame) -> DataFrame:
    s = stargazers
    return s.select("user_id", "user_login", _full_name().alias("repository_full_name"),
                    _ts("starred_at").alias("starred_at"))


def stg_issue_labels(issue_labels: DataFrame) -> DataFrame:
    """Input: the child table of ``issues.labels`` (sources.landing.child_table)."""
    l = issue_labels
    return l.select(
        F.col("_parent_row_id").alias("issue_dlt_id"),
        F.col("_list_idx").alias("label_position"),
        F.col("id").alias("label_id"),
        F.col("name").alias("label_name"),
        F.col("color").alias("label_color"),
        F.col("description").alias("label_description"),
        F.col("`default`").alias("is_default_label"),
    )


def stg_pr_labels(pr_labels: DataFrame) -> DataFrame:
    l = pr_labels
    return l.select(
        F.col("_parent_row_id").alias("pr_dlt_id"),
        F.col("_list_idx").alias("label_position"),
        F.col("id").alias("label_id"),
        F.col("name").alias("label_name"),
        F.col("color").alias("label_color"),
        F.col("description").alias("label_description"),
        F.col("`default`").alias("is_default_label"),
    )


def stg_repository_topics(repository_topics: DataFrame) -> DataFrame:
    t = repository_topics
    return t.select(
        F.col("_parent_row_id").alias("repository_dlt_id"),
        F.col("_list_idx").alias("topic_position"),
        F.col("value").alias("topic_name"),
    )


def stg_pr_reviews(pr_reviews: DataFrame) -> DataFrame:
    """Disabled in the reference (no reviews are extracted); built as an option."""
    r = pr_reviews
    return r.filter(F.col("user__id").isNotNull()).select(
        F.col("id").alias("review_id"),
        surrogate_key("_owner", "_repo").alias("repository_key"),
        F.col("_pr_number").cast("bigint").alias("pull_request_number"),
        F.col("user__id").alias("reviewer_user_id"),
        F.col("_owner").alias("repository_owner"),
        F.col("_repo").alias("repository_name"),
        F.col("state").alias("review_state"),
        F.col("body").alias("review_body"),
        "commit_id",
        _ts("submitted_at").alias("submitted_at"),
        F.col("_load_id").alias("_dlt_load_id"),
        F.col("_row_id").alias("_dlt_id"),
    )


def user_pairs(df: DataFrame, id_col: str, login_col: str) -> DataFrame:
    return df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("user_id"), F.col(login_col).alias("user_login"))


def users_of(pairs: DataFrame) -> DataFrame:
    """(id, login) pairs -> one row per id with its smallest login and bot flag.
    Duplicates go first, by hash aggregation, so that the minimum over strings (a
    sort aggregation) sees only the distinct pairs. They are counted, as the optimizer
    takes a bare ``distinct`` below a minimum out again."""
    distinct = pairs.groupBy("user_id", "user_login").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 0)
    dedup = distinct.groupBy("user_id").agg(F.min("user_login").alias("user_login"))
    return dedup.select("user_id", "user_login", is_bot_login("user_login").alias("is_bot"))


def stg_users(stg_issues_df: DataFrame, stg_prs: DataFrame, stg_comments: DataFrame,
              stg_commits_df: DataFrame, stg_stars: DataFrame) -> DataFrame:
    """Users of five sources: distinct (id, login) union, ``min(login)`` per id, bot flag."""
    pairs = user_pairs(stg_stars, "user_id", "user_login")
    for df in (stg_issues_df, stg_prs, stg_comments, stg_commits_df):
        pairs = pairs.unionByName(user_pairs(df, "author_id", "author_login"))
    return users_of(pairs)
