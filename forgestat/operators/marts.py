"""Dimensions and facts (M-17 ... M-22).

Join strategy (SURVEY 4):
* date roles: ``date_key`` is a pure function of the date inside the spine,
  so the three role-playing joins become a range check (``date_join=True``
  plans the broadcast join instead; the spine is bounded by its parameters);
* users: ``dim_users`` is built from exactly the sources whose user ids the
  facts carry, so every non-NULL fact user id has its row and the key equals
  ``surrogate_key(user_id)``; ``users_join=True`` plans the join instead
  (T-03 relationship checks verify the invariant);
* repositories: left join on the full name; the dimension is small and AQE
  turns the shuffle join into a broadcast at run time after measuring it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from forgestat.functions.keys import surrogate_key
from forgestat.functions.sizing import broadcast_if_bounded
from forgestat.operators.dates import date_key_in_spine


def dim_repositories(stg_repositories: DataFrame) -> DataFrame:
    r = stg_repositories
    return r.select(
        surrogate_key("repository_id").alias("repo_key"),
        "repository_id", "repository_full_name", "repository_name", "owner_login", "owner_id",
        "repository_description", "repository_url", "primary_language", "default_branch",
        "license_name", "stargazers_count", "watchers_count", "forks_count", "open_issues_count",
        "repository_size_kb", "has_issues", "has_projects", "has_wiki", "has_pages", "has_downloads",
        "is_private", "is_archived", "is_disabled", "created_at", "updated_at", "pushed_at")


def dim_users(stg_users: DataFrame) -> DataFrame:
    return stg_users.select(surrogate_key("user_id").alias("user_key"), "user_id", "user_login", "is_bot")


class FactContext:
    """Dimensions and join options shared by the fact builders."""

    def __init__(self, dim_repos, dim_users_df, dim_dates_df,
                 spine: tuple[dt.date, dt.date], date_join: bool = False, users_join: bool = False):
        # dimensions are passed as DataFrames or zero-argument builders, so a
        # dimension no join needs is never planned
        self._dims = {"repos": dim_repos, "users": dim_users_df, "dates": dim_dates_df}
        self.spine = spine
        self.date_join = date_join
        self.users_join = users_join

    def _dim(self, name: str) -> DataFrame:
        d = self._dims[name]
        if callable(d):
            d = self._dims[name] = d()
        return d

    @property
    def dim_repos(self) -> DataFrame:
        return self._dim("repos")

    @property
    def dim_users(self) -> DataFrame:
        return self._dim("users")

    @property
    def dim_dates(self) -> DataFrame:
        return self._dim("dates")

    def with_repo_key(self, df: DataFrame, full_name_col: str = "repository_full_name") -> DataFrame:
        r = self.dim_repos.select(F.col("repository_full_name").alias("_r_full"), "repo_key")
        return df.join(r, df[full_name_col] == r._r_full, "left").drop("_r_full")

    def with_user_key(self, df: DataFrame, id_col: str, out: str) -> DataFrame:
        if not self.users_join:
            return df.withColumn(out, F.when(F.col(id_col).isNotNull(), surrogate_key(id_col)))
        u = self.dim_users.select(F.col("user_id").alias("_u_id"), F.col("user_key").alias(out))
        return df.join(u, df[id_col] == u._u_id, "left").drop("_u_id")

    def with_date_key(self, df: DataFrame, ts_col: str, out: str) -> DataFrame:
        start, end = self.spine
        if not self.date_join:
            return df.withColumn(out, date_key_in_spine(ts_col, start, end))
        days = max((end - start).days, 0)
        d = broadcast_if_bounded(self.dim_dates.select(F.col("date").alias(f"_d_{out}"),
                                                       F.col("date_key").alias(out)), days)
        return df.join(d, df[ts_col].cast("date") == d[f"_d_{out}"], "left").drop(f"_d_{out}")


def fct_pull_requests(int_pr: DataFrame, ctx: FactContext) -> DataFrame:
    x = ctx.with_repo_key(int_pr)
    x = ctx.with_user_key(x, "author_id", "author_key")
    for ts, out in (("created_at", "created_date_key"), ("merged_at", "merged_date_key"),
                    ("closed_at", "closed_date_key")):
        x = ctx.with_date_key(x, ts, out)
    return x.select(
        surrogate_key("pull_request_id").alias("pr_key"), "pull_request_id", "pr_number", "repo_key",
        "author_key", "created_date_key", "merged_date_key", "closed_date_key", "pr_title", "pr_state",
        "is_merged", "is_draft", "is_closed", "is_closed_without_merge", "label_count", "comment_count",
        "time_to_first_comment_hours", "time_to_merge_hours", "time_to_close_without_merge_hours",
        "created_at", "updated_at", "closed_at", "merged_at")


def fct_issues(int_issue: DataFrame, ctx: FactContext) -> DataFrame:
    x = ctx.with_repo_key(int_issue)
    x = ctx.with_user_key(x, "author_id", "author_key")
    x = ctx.with_date_key(x, "created_at", "created_date_key")
    x = ctx.with_date_key(x, "closed_at", "closed_date_key")
    return x.select(
        surrogate_key("issue_id").alias("issue_key"), "issue_id", "issue_number", "repo_key", "author_key",
        "created_date_key", "closed_date_key", "issue_title", "issue_state", "is_closed", "is_assigned",
        "label_count", "is_bug", "is_enhancement", "comment_count", "time_to_close_hours",
        "time_to_first_response_hours", "created_at", "updated_at", "closed_at", "first_comment_at")


def fct_commits(stg_commits: DataFrame, ctx: FactContext) -> DataFrame:
    x = ctx.with_repo_key(stg_commits)
    x = ctx.with_user_key(x, "author_id", "author_key")
    x = ctx.with_date_key(x, "commit_date", "commit_date_key")
    return x.select(
        surrogate_key("commit_sha").alias("commit_key"), "commit_sha", "repo_key", "author_key",
        "commit_date_key", "commit_message", "message_length", "commit_author_name",
        "commit_author_email", "comment_count", "commit_date", "committer_date")


def fct_stargazers(stg_stargazers: DataFrame, ctx: FactContext) -> DataFrame:
    x = ctx.with_repo_key(stg_stargazers)
    x = ctx.with_user_key(x, "user_id", "user_key")
    x = ctx.with_date_key(x, "starred_at", "starred_date_key")
    return x.select(
        surrogate_key("user_id", "repository_full_name").alias("stargazer_key"), "repo_key", "user_key",
        "starred_date_key", "starred_at")
