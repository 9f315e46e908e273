"""Registry of every implemented model / query / check with its oracle SQL.

``queries()`` entries take ``(spark, sf_dir)`` and return a DataFrame over the
driver's tables (through the adapters); ``oracle_sql()`` holds the DuckDB SQL
of the same result. Audit columns are not part of any compared output.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from forgestat.functions.sizing import deal_by_size
from forgestat.operators import intermediate, quality
from forgestat.plans import analysis
from forgestat.plans.oracle_sql import compose
from forgestat.plans.warehouse import Warehouse, driver_warehouse
from forgestat.sources import ingest, landing
from forgestat.sources.adapters import FORBIDDEN_EVERY, MISSING_EVERY, TORN_EVERY

Entry = tuple[Callable[[Warehouse], DataFrame], str | None]
ENTRIES: dict[str, Entry] = {}


def register(name: str, spark_fn: Callable[[Warehouse], DataFrame], final_sql: str | None,
             deps: list[str] | None = None) -> None:
    ENTRIES[name] = (spark_fn, None if final_sql is None else compose(final_sql, deps or []))


def _model(attr: str):
    return lambda wh: getattr(wh, attr)


# ---- models M-01 ... M-27 -------------------------------------------------------
for _name, _attr in [
    ("m01_stg_repositories", "stg_repositories"), ("m02_stg_issues", "stg_issues"),
    ("m03_stg_pull_requests", "stg_pull_requests"), ("m04_stg_issue_comments", "stg_issue_comments"),
    ("m05_stg_commits", "stg_commits"), ("m06_stg_releases", "stg_releases"),
    ("m07_stg_stargazers", "stg_stargazers"), ("m08_stg_issue_labels", "stg_issue_labels"),
    ("m09_stg_pr_labels", "stg_pr_labels"), ("m10_stg_repository_topics", "stg_repository_topics"),
    ("m12_stg_users", "stg_users"), ("m13_int_contributor_activity", "int_contributor_activity"),
    ("m14_int_issue_lifecycle", "int_issue_lifecycle"), ("m15_int_pr_with_reviews", "int_pr_with_reviews"),
    ("m16_dim_dates", "dim_dates"), ("m17_dim_repositories", "dim_repositories"), ("m18_dim_users", "dim_users"),
    ("m19_fct_pull_requests", "fct_pull_requests"), ("m20_fct_issues", "fct_issues"),
    ("m21_fct_commits", "fct_commits"), ("m22_fct_stargazers", "fct_stargazers"),
    ("m23_pr_cycle_time", "pr_cycle_time"), ("m24_contributor_engagement", "contributor_engagement"),
    ("m25_top_contributors", "top_contributors"), ("m26_release_velocity", "release_velocity"),
    ("m27_commits_per_release", "commits_per_release"),
]:
    register(_name, _model(_attr), f"SELECT * FROM {_attr}", [_attr])

# W-01 / W-02: the row-level release intervals (ties ordered by release id)
register("w01_release_intervals", _model("release_intervals"), "SELECT * FROM release_intervals_rows",
         ["release_intervals_rows"])

# The reference's disabled reviews path (M-11 -> A-05 -> J-04), run on a
# warehouse whose bronze includes the adapters' landed reviews.
WITH_REVIEWS = {"m11_stg_pr_reviews", "m15r_int_pr_with_reviews_enabled", "a05_review_stats",
                "t01_t02_review_tests", "src04_pr_reviews_json"}
register("m11_stg_pr_reviews", _model("stg_pr_reviews"), "SELECT * FROM stg_pr_reviews", ["stg_pr_reviews"])
register("a05_review_stats", lambda wh: intermediate.review_stats(wh.stg_pr_reviews),
         "SELECT * FROM review_stats", ["review_stats"])
register("m15r_int_pr_with_reviews_enabled", _model("int_pr_with_reviews"),
         "SELECT * FROM int_pr_with_reviews_on", ["int_pr_with_reviews_on"])

# ---- analytical queries Q-01 ... Q-15 ---------------------------------------------
def _hours(table: str, key: str, keep: str, hours: str) -> str:
    """Per repository: how many rows, and mean and median of a duration in hours and days."""
    return f"""(SELECT {key} AS repo, count(*) AS n, avg({hours}) AS mean_h, median({hours}) AS mid_h
      FROM {table} WHERE {keep} GROUP BY {key})"""


def _named(inner: str, columns: str) -> str:
    """``columns`` over rows (repo, ...) folded to the repository's name."""
    return f"SELECT {columns} FROM {inner} AS x INNER JOIN dim_repositories AS d ON d.repo_key = x.repo"


_BY_NAME = "SELECT d.repository_name, t.* FROM {0} AS t INNER JOIN dim_repositories AS d USING (repo_key)"
_HUMAN = """SELECT p.user_login, act.repository_full_name, act.activity_type, act.activity_at FROM int_contributor_activity AS act
      INNER JOIN (SELECT user_id, user_login FROM dim_users WHERE NOT is_bot) AS p USING (user_id)"""


def _spans(table: str, done: str, hours: str, count: str, verb: str) -> str:
    return f"""WITH t AS ({_BY_NAME.format(table)}), s AS (
      SELECT repository_name, count(*) AS {count}, avg({hours}) AS mean_h, median({hours}) AS mid_h
      FROM t WHERE {done} AND {hours} IS NOT NULL GROUP BY 1)
    SELECT repository_name, {count}, round(mean_h, 2) AS avg_hours_to_{verb}, round(mid_h, 2) AS median_hours_to_{verb},
      round(mean_h / 24, 2) AS avg_days_to_{verb}, round(mid_h / 24, 2) AS median_days_to_{verb} FROM s"""


def _share(part: str, whole: str) -> str:
    return f"round(100.0 * CAST({part} AS DOUBLE) / {whole}, 2)"


def _kinds(*pairs: tuple[str, str]) -> str:
    return ", ".join(f"count(*) FILTER (WHERE activity_type = '{kind}_created') AS {name}" for kind, name in pairs)


# The columns of the four reports that only list a model, in the
# reports' order; a number is the decimals shown, a second name what it is shown as.
REPORTS = {
    "q01": ["repository_name", "repository_full_name", "primary_language", "stargazers_count", "forks_count",
            "open_issues_count", "created_at", "pushed_at"],
    "q11": ["repository_name", "period_type", "year", "period_number", "merged_pr_count", "median_days_to_merge",
            "p90_days_to_merge"],
    "q12": ["repository_full_name", "year", "month", "unique_contributors", "new_contributors", "returning_contributors",
            ("returning_contributor_pct", 2, "returning_pct"), "total_activities",
            ("activities_per_contributor", 2, "activities_per_contributor")],
    "q13": ["repository_name", "period_type", "year", "period_number", "release_count", "stable_release_count",
            ("avg_days_between_releases", 1, "avg_days_between_releases"),
            ("median_days_between_releases", 1, "median_days_between_releases")],
}


def _plain(model: str, report: str, where: str = "true") -> str:
    columns = [c if isinstance(c, str) else f"round({c[0]}, {c[1]}) AS {c[2]}" for c in REPORTS[report]]
    return f"SELECT {', '.join(columns)} FROM {model} WHERE {where}"


Q_SQL = {
    "q01_repository_stats": (_plain("dim_repositories", "q01"), ["dim_repositories"]),
    "q02_pr_cycle_time_by_repo": (_spans("fct_pull_requests", "is_merged", "time_to_merge_hours", "total_merged_prs", "merge"),
                                  ["fct_pull_requests", "dim_repositories"]),
    "q03_pr_merge_rate": (f"""WITH s AS (SELECT repository_name, count(*) AS total_prs,
        count(*) FILTER (WHERE is_merged) AS merged_prs FROM ({_BY_NAME.format("fct_pull_requests")}) GROUP BY 1)
      SELECT *, {_share("merged_prs", "total_prs")} AS merge_rate_pct FROM s""", ["fct_pull_requests", "dim_repositories"]),
    "q04_slowest_prs": (f"""WITH t AS (SELECT n.*, p.user_login FROM ({_BY_NAME.format("fct_pull_requests")}) AS n
        INNER JOIN dim_users AS p ON p.user_key = n.author_key WHERE n.is_merged), k AS (
        SELECT *, row_number() OVER (ORDER BY time_to_merge_hours DESC, pull_request_id) AS place FROM t)
      SELECT repository_name, pr_number, pr_title, user_login AS author, created_at, merged_at,
        round(time_to_merge_hours / 24, 2) AS days_to_merge FROM k WHERE place <= 20""",
                        ["fct_pull_requests", "dim_repositories", "dim_users"]),
    "q05_issue_resolution": (_spans("fct_issues", "is_closed", "time_to_close_hours", "total_closed_issues", "close"),
                             ["fct_issues", "dim_repositories"]),
    "q06_bug_vs_enhancement": (f"""WITH s AS (SELECT repository_name, count(*) AS total_issues,
        count(*) FILTER (WHERE is_bug) AS bug_issues, count(*) FILTER (WHERE is_enhancement) AS enhancement_issues
        FROM ({_BY_NAME.format("fct_issues")}) GROUP BY 1)
      SELECT *, {_share("bug_issues", "total_issues")} AS bug_pct,
        {_share("enhancement_issues", "total_issues")} AS enhancement_pct FROM s""", ["fct_issues", "dim_repositories"]),
    "q07_top_contributors": (f"""WITH s AS (SELECT user_login, false AS is_bot, min(activity_at) AS first_activity,
        max(activity_at) AS last_activity, count(*) AS total_activities, count(DISTINCT activity_type) AS activity_types,
        count(DISTINCT repository_full_name) AS repos_contributed_to FROM ({_HUMAN}) GROUP BY 1), k AS (
        SELECT *, row_number() OVER (ORDER BY total_activities DESC, user_login) AS place FROM s)
      SELECT user_login, is_bot, total_activities, activity_types, repos_contributed_to, first_activity, last_activity
      FROM k WHERE place <= 20""", ["int_contributor_activity", "dim_users"]),
    "q08_contributor_breakdown": (f"""WITH s AS (SELECT user_login, count(*) AS total_activities,
        {_kinds(("comment", "comments"), ("commit", "commits"), ("issue", "issues"), ("pr", "prs"))}
        FROM ({_HUMAN}) GROUP BY 1), k AS (
        SELECT *, row_number() OVER (ORDER BY total_activities DESC, user_login) AS place FROM s)
      SELECT user_login, commits, prs, issues, comments, total_activities FROM k WHERE place <= 20""",
                                  ["int_contributor_activity", "dim_users"]),
    "q09_cumulative_stars": (f"""WITH days AS (SELECT n.repository_name, cal.date, count(*) AS new_stars
        FROM ({_BY_NAME.format("fct_stargazers")}) AS n INNER JOIN dim_dates AS cal ON cal.date_key = n.starred_date_key
        GROUP BY 1, 2)
      SELECT a.date, a.repository_name, a.new_stars, CAST(sum(a.new_stars) OVER (
        PARTITION BY a.repository_name ORDER BY a.date) AS BIGINT) AS cumulative_stars FROM days AS a""",
                             ["fct_stargazers", "dim_dates", "dim_repositories"]),
    "q10_monthly_pr_activity": (f"""WITH s AS (SELECT cal.year, cal.month, n.repository_name, count(*) AS prs_created,
        count(*) FILTER (WHERE n.is_merged) AS prs_merged, avg(n.time_to_merge_hours) AS mean_h
        FROM dim_dates AS cal INNER JOIN ({_BY_NAME.format("fct_pull_requests")}) AS n ON n.created_date_key = cal.date_key
        GROUP BY 1, 2, 3)
      SELECT year, month, repository_name, prs_created, prs_merged, round(mean_h / 24, 2) AS avg_days_to_merge FROM s""",
                                ["fct_pull_requests", "dim_dates", "dim_repositories"]),
    "q11_cycle_time_trend": (_plain("pr_cycle_time", "q11", "period_type = 'monthly'"), ["pr_cycle_time"]),
    "q12_engagement_trend": (_plain("contributor_engagement", "q12"), ["contributor_engagement"]),
    "q13_release_velocity": (_plain("release_velocity", "q13", "period_type = 'monthly'"), ["release_velocity"]),
    "q14_contributor_retention": ("""WITH seen AS (SELECT DISTINCT repository_full_name, user_id,
        date_trunc('month', activity_at) AS activity_month FROM int_contributor_activity WHERE NOT is_bot), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY repository_full_name, user_id ORDER BY activity_month) AS nth FROM seen
        WHERE user_id IS NOT NULL)
      SELECT repository_full_name, activity_month, count(*) AS active_contributors,
        count(*) FILTER (WHERE nth = 1) AS new_contributors, count(*) FILTER (WHERE nth > 1) AS returning_contributors
      FROM ranked GROUP BY 1, 2""", ["int_contributor_activity"]),
    "q15_first_comment_responsiveness": (_named(
        _hours("fct_pull_requests", "repo_key", "time_to_first_comment_hours IS NOT NULL", "time_to_first_comment_hours"),
        """d.repository_name, x.n AS total_prs, x.n AS prs_with_comments, round(x.mean_h, 2) AS avg_hours_to_first_comment,
      round(x.mid_h, 2) AS median_hours_to_first_comment, round(x.mean_h / 24, 2) AS avg_days_to_first_comment"""),
                                         ["fct_pull_requests", "dim_repositories"]),
}
for _name, _fn in analysis.QUERIES.items():
    _sql, _deps = Q_SQL[_name]
    if _sql.lstrip().upper().startswith("WITH "):
        # the query has its own WITH: splice its CTEs after the shared ones
        _inner = _sql.lstrip()[5:]
        ENTRIES[_name] = (_fn, compose("", _deps).rstrip() + ",\n" + _inner)
    else:
        register(_name, _fn, _sql, _deps)


# ---- data quality T-01 ... T-08 ------------------------------------------------------
def _mart_models(wh: Warehouse) -> dict[str, DataFrame]:
    return {s.model: getattr(wh, s.model) for s in quality.MART_TESTS} | {
        "dim_dates": wh.dim_dates, "dim_users": wh.dim_users, "dim_repositories": wh.dim_repositories}


def _mart_tests_sql(specs=None) -> tuple[str, list[str]]:
    parts, deps = [], set()
    for s in (quality.MART_TESTS if specs is None else specs):
        deps.add(s.model)
        m = s.model
        for c in s.unique:
            parts.append(f"SELECT '{m}' AS model, 'unique' AS test, '{c}' AS column_name, "
                         f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL "
                         f"GROUP BY {c} HAVING count(*) > 1) repeated")
        for c in s.not_null:
            parts.append(f"SELECT '{m}', 'not_null', '{c}', CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) FROM {m}")
        for c, e, w in s.expressions:
            parts.append(f"SELECT '{m}', 'expression_is_true', '{c}', "
                         f"CAST(count(*) FILTER (WHERE ({w}) AND NOT ({e})) AS BIGINT) FROM {m}")
        for c, vals in s.accepted:
            lst = ", ".join(f"'{v}'" for v in vals)
            parts.append(f"SELECT '{m}', 'accepted_values', '{c}', "
                         f"CAST(count(*) FILTER (WHERE {c} NOT IN ({lst})) AS BIGINT) FROM {m}")
        for c, parent, pf in s.relationships:
            deps.add(parent)
            parts.append(f"SELECT '{m}', 'relationships', '{c}', CAST(count(*) AS BIGINT) FROM {m} ch "
                         f"WHERE ch.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pf} = ch.{c})")
    return "\nUNION ALL\n".join(parts), sorted(deps)


_mt_sql, _mt_deps = _mart_tests_sql()
DECISIONS = ["APPROVED", "CHANGES_REQUESTED"]
# Reviews as they land: ids repeat, some have no author, some decide nothing.
LANDED_REVIEW_TESTS = [quality.ModelTests("b_pr_reviews_landed", unique=["id"], not_null=["id", "user__id"],
                                          accepted=[("state", DECISIONS)])]


def _layer_models(wh: Warehouse) -> dict[str, DataFrame]:
    from forgestat.sources.landing import child_table
    b = wh.bronze
    out = {f"b_{e}": b[e] for e in ("repositories", "issues", "pull_requests", "issue_comments", "commits",
                                     "releases", "stargazers", "contributors")}
    out["c_issue_labels"] = child_table(b["issues"], "labels")
    out["c_pr_labels"] = child_table(b["pull_requests"], "labels")
    out["c_repository_topics"] = child_table(b["repositories"], "topics")
    for s in quality.STAGING_TESTS:
        out[s.model] = getattr(wh, s.model)
    return out


def _steps_of(specs: list, together: list[set[str]]) -> list[list]:
    """Specs by the sets of entities or models that are tested together; others by themselves."""
    out: dict[int | str, list] = {}
    for s in specs:
        entity = s.model.removeprefix("b_").removeprefix("c_").removeprefix("stg_")
        out.setdefault(next((k for k, names in enumerate(together) if entity in names), entity), []).append(s)
    return list(out.values())


# What is tested together reads the same tables, of which one shuffle may serve all.
_LAYER_STEPS = _steps_of(quality.SOURCE_TESTS + quality.STAGING_TESTS, [
    {"repositories", "repository_topics", "releases", "contributors"}, {"issues", "issue_labels"}, {"pull_requests", "pr_labels"}])
_MART_STEPS = _steps_of(quality.MART_TESTS, [{"dim_repositories", "dim_users", "dim_dates", "release_velocity"}])
_st_sql, _st_deps = _mart_tests_sql(quality.SOURCE_TESTS + quality.STAGING_TESTS)
register("t01_t02_source_staging_tests",
         lambda wh: quality.run_tests_in_steps(_layer_models(wh), _LAYER_STEPS),
         _st_sql, _st_deps)
_rt_sql, _rt_deps = _mart_tests_sql(quality.REVIEW_TESTS)
WITH_REVIEWS_TESTS = "t01_t02_review_tests"
register(WITH_REVIEWS_TESTS, lambda wh: quality.run_mart_tests({"stg_pr_reviews": wh.stg_pr_reviews},
                                                              quality.REVIEW_TESTS), _rt_sql, _rt_deps)
register("t01_t05_mart_tests", lambda wh: quality.run_tests_in_steps(_mart_models(wh), _MART_STEPS), _mt_sql, _mt_deps)
register("t01_unique_failures_fct_stargazers",
         lambda wh: quality.unique_failures(wh.fct_stargazers, "stargazer_key"),
         "SELECT stargazer_key, count(*) AS n_records FROM fct_stargazers WHERE stargazer_key IS NOT NULL "
         "GROUP BY stargazer_key HAVING count(*) > 1", ["fct_stargazers"])
register("t02_not_null_failures_fct_commits",
         lambda wh: quality.not_null_failures(wh.fct_commits, "repo_key").select("commit_key", "commit_sha", "repo_key"),
         "SELECT commit_key, commit_sha, repo_key FROM fct_commits WHERE repo_key IS NULL", ["fct_commits"])
register("t03_relationship_failures_fct_pull_requests",
         lambda wh: quality.relationship_failures(wh.fct_pull_requests, "created_date_key", wh.dim_dates, "date_key")
         .select("pr_key", "created_date_key"),
         "SELECT pr_key, created_date_key FROM fct_pull_requests f WHERE created_date_key IS NOT NULL AND NOT EXISTS "
         "(SELECT 1 FROM dim_dates d WHERE d.date_key = f.created_date_key)", ["fct_pull_requests", "dim_dates"])
register("t04_accepted_values_failures_pr_cycle_time",
         lambda wh: quality.accepted_values_failures(wh.pr_cycle_time, "period_type", ["weekly", "monthly"]),
         "SELECT * FROM pr_cycle_time WHERE period_type NOT IN ('weekly', 'monthly')", ["pr_cycle_time"])
register("t05_expression_failures_fct_issues",
         lambda wh: quality.expression_failures(wh.fct_issues, "time_to_close_hours >= 0",
                                                "time_to_close_hours is not null")
         .select("issue_key", "issue_id", "time_to_close_hours"),
         "SELECT issue_key, issue_id, time_to_close_hours FROM fct_issues WHERE time_to_close_hours IS NOT NULL "
         "AND NOT (time_to_close_hours >= 0)", ["fct_issues"])
register("t06_orphan_prs", lambda wh: quality.orphan_prs(wh.fct_pull_requests),
         "SELECT pr_key, repo_key FROM fct_pull_requests WHERE repo_key IS NULL", ["fct_pull_requests"])
register("t07_negative_cycle_time", lambda wh: quality.negative_cycle_time(wh.fct_pull_requests),
         "SELECT pr_key, pull_request_id, time_to_merge_hours FROM fct_pull_requests WHERE is_merged = true "
         "AND time_to_merge_hours IS NOT NULL AND time_to_merge_hours < 0", ["fct_pull_requests"])

# The same checks on relations of these tables that do fail.
register("t01_unique_failures_landed_comments",
         lambda wh: quality.unique_failures(wh.adapters.issue_comments_landed, "id"),
         "SELECT id, count(*) AS n_records FROM b_comments_landed GROUP BY id HAVING count(*) > 1", ["b_comments_landed"])
register("t01_t02_landed_review_tests",
         lambda wh: quality.run_mart_tests({"b_pr_reviews_landed": wh.adapters.pr_reviews_landed}, LANDED_REVIEW_TESTS),
         *_mart_tests_sql(LANDED_REVIEW_TESTS))
register("t02_not_null_failures_review_authors",
         lambda wh: quality.not_null_failures(wh.adapters.pr_reviews, "user__id").select("id", "user__id"),
         "SELECT id, user__id FROM b_pr_reviews WHERE user__id IS NULL", ["b_pr_reviews"])
register("t03_relationship_failures_prs_in_reviews",
         lambda wh: quality.relationship_failures(wh.stg_pull_requests, "pr_number", wh.adapters.pr_reviews, "_pr_number")
         .select("pull_request_id", "pr_number"),
         "SELECT pull_request_id, pr_number FROM stg_pull_requests WHERE pr_number NOT IN "
         "(SELECT _pr_number FROM b_pr_reviews)", ["stg_pull_requests", "b_pr_reviews"])
register("t04_accepted_values_failures_review_states",
         lambda wh: quality.accepted_values_failures(wh.adapters.pr_reviews, "state", DECISIONS).select("id", "state"),
         "SELECT id, state FROM b_pr_reviews WHERE state <> 'APPROVED' AND state <> 'CHANGES_REQUESTED'", ["b_pr_reviews"])

# Freshness of each source with a cursor field, at a fixed as-of instant.
FRESHNESS_AS_OF = dt.datetime(2001, 9, 1, 0, 0, 0)
FRESHNESS_SOURCES = [("issues", "stg_issues", "updated_at"), ("pull_requests", "stg_pull_requests", "updated_at"),
                     ("issue_comments", "stg_issue_comments", "updated_at"), ("commits", "stg_commits", "commit_date"),
                     ("releases", "stg_releases", "published_at"), ("stargazers", "stg_stargazers", "starred_at")]


def _freshness(wh: Warehouse, as_of: dt.datetime = FRESHNESS_AS_OF) -> DataFrame:
    out = None
    for src, model, col in FRESHNESS_SOURCES:
        f = quality.freshness(getattr(wh, model), src, col, as_of)
        out = f if out is None else out.unionByName(f)
    return out


def _freshness_sql(as_of: dt.datetime) -> str:
    parts = []
    for src, model, col in FRESHNESS_SOURCES:
        age = f"round((epoch_us(TIMESTAMP '{as_of:%Y-%m-%d %H:%M:%S}') - epoch_us(max({col}))) / 3600000000.0, 3)"
        parts.append(f"""SELECT '{src}' AS source, max({col}) AS max_loaded_at, CAST({age} AS DOUBLE) AS age_hours,
  CASE WHEN max({col}) IS NULL THEN 'error' WHEN {age} > {quality.ERROR_AFTER_HOURS} THEN 'error'
       WHEN {age} > {quality.WARN_AFTER_HOURS} THEN 'warn' ELSE 'pass' END AS status FROM {model}""")
    return "\nUNION ALL\n".join(parts)


_FRESHNESS_DEPS = [m for _, m, _ in FRESHNESS_SOURCES]
register("t08_source_freshness", _freshness, _freshness_sql(FRESHNESS_AS_OF), _FRESHNESS_DEPS)
# Two instants after the newest row of every source: a day later, two days later.
FRESHNESS_AFTER = [dt.datetime(2024, 1, 31, 12, 0, 0), dt.datetime(2024, 2, 1, 12, 0, 0)]
register("t08_source_freshness_after_data",
         lambda wh: _freshness(wh, FRESHNESS_AFTER[0]).unionByName(_freshness(wh, FRESHNESS_AFTER[1])),
         "\nUNION ALL\n".join(map(_freshness_sql, FRESHNESS_AFTER)), _FRESHNESS_DEPS)


# ---- ingest: cursors and write modes (SRC-10 ... SRC-13, SRC-18) -----------------------
CURSOR_SPLIT = "1998-01-01 00:00:00"


def _src10(wh: Warehouse) -> DataFrame:
    """Second run of an incremental load: the cursor state left by a first
    run that saw issues updated before the split; the rows the second run
    takes (``>=`` the cursor of their repository)."""
    issues = wh.bronze["issues"]
    first = issues.filter(F.col("updated_at") < F.lit(CURSOR_SPLIT).cast("timestamp_ntz"))
    cursors = ingest.next_cursors(first, "issues", "updated_at", None)
    taken = ingest.apply_cursor(issues, "issues", "updated_at", cursors, initial="1900-01-01 00:00:00")
    return taken.select("id", "number", "_owner", "_repo", "updated_at")


register("src10_incremental_cursor", _src10, f"""SELECT i.id, i.number, i._owner, i._repo, i.updated_at FROM b_issues i
  LEFT JOIN (SELECT _owner, _repo, max(updated_at) AS last_value FROM b_issues
             WHERE updated_at < TIMESTAMP '{CURSOR_SPLIT}' GROUP BY _owner, _repo) c
    ON i._owner = c._owner AND i._repo = c._repo
  WHERE i.updated_at >= coalesce(c.last_value, TIMESTAMP '1900-01-01 00:00:00')""", ["b_issues"])
register("src10_next_cursors",
         lambda wh: ingest.next_cursors(wh.bronze["issue_comments"], "issue_comments", "updated_at",
                                        ingest.next_cursors(wh.bronze["issues"], "issues", "updated_at", None)),
         """SELECT 'issues' AS entity, _owner, _repo, max(updated_at) AS last_value FROM b_issues GROUP BY _owner, _repo
  UNION ALL SELECT 'issue_comments', _owner, _repo, max(updated_at) FROM b_issue_comments GROUP BY _owner, _repo""",
         ["b_issues", "b_issue_comments"])
register("src11_merge_upsert", lambda wh: wh.bronze["issue_comments"], "SELECT * FROM b_issue_comments",
         ["b_issue_comments"])
# An existing table meets a batch with older, equal and newer versions of its keys.
MERGE_OLD, MERGE_NEW = "1998-07-01 00:00:00", "1997-01-01 00:00:00"


def _src11b(wh: Warehouse) -> DataFrame:
    landed, order = wh.adapters.issue_comments_facts, ["updated_at", "body"]
    existing = ingest.upsert(landed.filter(F.col("updated_at") < F.lit(MERGE_OLD).cast("timestamp_ntz")), ["id"], order)
    batch = landed.filter(F.col("updated_at") >= F.lit(MERGE_NEW).cast("timestamp_ntz"))
    return wh.adapters.issue_comments_named(ingest.merge_into(existing, batch, ["id"], order))


register("src11b_merge_into_existing", _src11b, "SELECT * FROM b_issue_comments", ["b_issue_comments"])
STAR_SPLIT = "1998-01-01 00:00:00"
register("src12_append_new",
         lambda wh: ingest.append_new(
             wh.bronze["stargazers"].filter(F.col("starred_at") < F.lit(STAR_SPLIT).cast("timestamp_ntz")),
             wh.bronze["stargazers"], ["user_id", "_owner", "_repo", "starred_at"]),
         f"""SELECT * FROM b_stargazers s WHERE NOT EXISTS (SELECT 1 FROM b_stargazers e
  WHERE e.starred_at < TIMESTAMP '{STAR_SPLIT}' AND e.user_id = s.user_id AND e._owner = s._owner
    AND e._repo = s._repo AND e.starred_at = s.starred_at)""", ["b_stargazers"])
register("src13_replace_partitions",
         lambda wh: ingest.replace_partitions(
             wh.bronze["contributors"].filter(F.col("_owner") == "ASIA")
               .withColumn("contributions", F.col("contributions") * 2),
             wh.bronze["contributors"]),
         """SELECT user_id, user_login, user_type, contributions, _owner, _repo, _load_id FROM b_contributors
  WHERE _owner <> 'ASIA'
  UNION ALL SELECT user_id, user_login, user_type, contributions * 2, _owner, _repo, _load_id FROM b_contributors
  WHERE _owner = 'ASIA'""", ["b_contributors"])
register("src18_load_summary", lambda wh: ingest.load_summary(wh.bronze),
         "\nUNION ALL\n".join(f"SELECT '{e}' AS table_name, count(*) AS row_count FROM b_{e}" for e in (
             "repositories", "issues", "pull_requests", "issue_comments", "commits", "releases", "stargazers",
             "contributors")),
         ["b_" + e for e in ("repositories", "issues", "pull_requests", "issue_comments", "commits", "releases",
                             "stargazers", "contributors")])


# ---- landed JSON of every entity (SRC-01 ... SRC-09, SRC-14 ... SRC-17) --------------
def _from_json(wh: Warehouse, entity: str) -> DataFrame:
    """The entity's rows as landed JSON text, parsed by the declared schema,
    flattened and stamped: what the daily run does with files."""
    lines = landing.as_landed(wh.bronze[entity], entity)
    parsed = landing.parse_landed(lines, entity).filter(F.col("_corrupt_record").isNull())
    return landing.to_bronze(parsed, entity, wh.params.load_id)


def _json_rows(entity: str, arrays: tuple[str, ...]):
    return lambda wh: _from_json(wh, entity).select(*[c for c in wh.bronze[entity].columns if c not in arrays])


for _name, _entity, _arrays in [
    ("src01_repositories_json", "repositories", ("topics",)), ("src02_issues_json", "issues", ("labels",)),
    ("src03_pull_requests_json", "pull_requests", ("labels",)), ("src04_pr_reviews_json", "pr_reviews", ()),
    ("src05_issue_comments_json", "issue_comments", ()), ("src06_commits_json", "commits", ()),
    ("src07_releases_json", "releases", ()), ("src08_stargazers_json", "stargazers", ()),
    ("src09_contributors_json", "contributors", ()),
]:
    _but = f" EXCLUDE ({', '.join(_arrays)})" if _arrays else ""
    register(_name, _json_rows(_entity, _arrays), f"SELECT *{_but} FROM b_{_entity}", [f"b_{_entity}"])


# ---- reviews with access status (SRC-04), malformed lines (ST-01's quarantine) ---------
def _opened(wh: Warehouse) -> DataFrame:
    """Answers as landed JSON text, parsed by the declared schema and opened."""
    answers = wh.adapters.review_responses
    lines = answers.select(F.to_json(F.struct("_pr_number", "status", "reviews"),
                                     {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value"), "_owner", "_repo")
    parsed = landing.parse_landed(lines, "pr_review_responses").filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return landing.open_reviews(parsed)


def _review_access(wh: Warehouse) -> DataFrame:
    """Per repository: answers by status, readable reviews, and those that meet
    their pull request by owner, repository and number."""
    opened = _opened(wh)
    prs = wh.bronze["pull_requests"].select("_owner", "_repo", F.col("number").alias("_pr_number"))
    met = (landing.readable_reviews(opened).join(prs, ["_owner", "_repo", "_pr_number"])
           .groupBy("_owner", "_repo").agg(F.count("*").alias("joined_reviews")))
    return (landing.review_access(opened).join(met, ["_owner", "_repo"], "left")
            .withColumn("joined_reviews", F.coalesce("joined_reviews", F.lit(0))))


_READ = f"_pr_number % {FORBIDDEN_EVERY} <> 0 AND _pr_number % {MISSING_EVERY} <> 0"
register("src04_review_access", _review_access, f"""SELECT _owner, _repo,
    count(DISTINCT _pr_number) FILTER (WHERE {_READ}) AS readable_pull_requests,
    count(DISTINCT _pr_number) FILTER (WHERE _pr_number % {FORBIDDEN_EVERY} = 0) AS forbidden_count,
    count(DISTINCT _pr_number) FILTER (WHERE _pr_number % {FORBIDDEN_EVERY} <> 0 AND _pr_number % {MISSING_EVERY} = 0) AS not_found_count,
    count(*) FILTER (WHERE {_READ}) AS accessible_count,
    count(*) FILTER (WHERE {_READ} AND (_owner, _repo, _pr_number) IN (SELECT (_owner, _repo, number) FROM b_pull_requests)) AS joined_reviews
  FROM b_pr_reviews GROUP BY ALL""", ["b_pr_reviews", "b_pull_requests"])


def _torn(wh: Warehouse) -> DataFrame:
    """Landed issue lines, some cut short: per repository how many parse, how
    many go to quarantine."""
    issues = wh.bronze["issues"]
    lines = landing.as_landed(issues.select("id", "number", "state", "updated_at", "_owner", "_repo"), "issues")
    torn = F.get_json_object("value", "$.id").cast("long") % TORN_EVERY == 0
    lines = lines.withColumn("value", F.when(torn, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")))
    bad = F.col("_corrupt_record").isNotNull()
    return landing.parse_landed(lines, "issues").groupBy("_owner", "_repo").agg(
        F.count_if(~bad).alias("parsed_lines"), F.count_if(bad).alias("quarantined_lines"))


register("src_quarantine_counts", _torn, f"""SELECT _owner, _repo, count(*) FILTER (WHERE id % {TORN_EVERY} <> 0) AS parsed_lines,
    count(*) FILTER (WHERE id % {TORN_EVERY} = 0) AS quarantined_lines FROM b_issues GROUP BY ALL""", ["b_issues"])


def _undeclared(wh: Warehouse) -> DataFrame:
    """Landed pull requests read by the schema of issues, which lacks some of their
    fields: those are kept beside the row and made typed columns afterwards."""
    lines = landing.as_landed(wh.bronze["pull_requests"], "pull_requests")
    parsed = landing.parse_landed(lines.withColumn("_extra", landing.extra_fields(F.col("value"), "issues")), "issues")
    typed = landing.with_fields(landing.to_bronze(parsed, "issues", wh.params.load_id), {
        "draft": "boolean", "merged_at": "timestamp", "merge_commit_sha": "string", "head": "struct<ref string, sha string>"})
    return typed.select("_owner", "_repo", "id", "title", "user__login", "draft", F.col("merged_at").cast("timestamp_ntz").alias("merged_at"),
                        "merge_commit_sha", F.col("head.ref").alias("head_ref"), F.col("head.sha").alias("head_sha"))


register("src_undeclared_fields", _undeclared, """SELECT _owner, _repo, id, title, user__login, draft, CAST(merged_at AS TIMESTAMP) AS merged_at,
    merge_commit_sha, head__ref AS head_ref, head__sha AS head_sha FROM b_pull_requests""", ["b_pull_requests"])


def _undeclared_of_labels(wh: Warehouse) -> DataFrame:
    """Landed issues whose labels have fields that the schema lacks, some labels
    without them: kept beside the issue by position, typed columns of the labels' table."""
    value = F.struct("id", F.transform("labels", lambda x: F.struct(
        x["id"].alias("id"), x["name"].alias("name"), F.when(x["id"] % 3 != 0, F.upper(x["name"])).alias("slug"),
        F.struct(x["color"].alias("hex"), x["id"].alias("weight")).alias("style"))).alias("labels"))
    lines = wh.bronze["issues"].select(F.to_json(value).alias("value"), "_owner", "_repo")
    parsed = landing.parse_landed(lines.withColumn("_extra", landing.extra_fields(F.col("value"), "issues")), "issues")
    children = landing.child_table(landing.to_bronze(parsed, "issues", wh.params.load_id), "labels",
                                   fields={"slug": "string", "style": "struct<hex string, weight bigint>"})
    return children.select("_parent_row_id", "_list_idx", "id", "name", "slug", F.col("style.hex").alias("hex"),
                           F.col("style.weight").alias("weight"))


register("src_undeclared_list_fields", _undeclared_of_labels, """SELECT _parent_row_id, _list_idx, _elem.id AS id, _elem.name AS name,
    CASE WHEN _elem.id % 3 <> 0 THEN upper(_elem.name) END AS slug, _elem.color AS hex, _elem.id AS weight FROM c_issue_labels""",
         ["c_issue_labels"])
_LABEL_SQL = ", ".join(f'_elem."{c}" AS "{c}"' for c in ("id", "name", "color", "description", "default"))
for _name, _entity, _array, _cte, _spread in [
    ("src16_issue_labels_json", "issues", "labels", "c_issue_labels", _LABEL_SQL),
    ("src16_pr_labels_json", "pull_requests", "labels", "c_pr_labels", _LABEL_SQL),
    ("src16_repository_topics_json", "repositories", "topics", "c_repository_topics", "_elem AS value"),
]:
    register(_name, lambda wh, e=_entity, a=_array: landing.child_table(_from_json(wh, e), a),
             f"SELECT _parent_row_id, _list_idx, {_spread} FROM {_cte}", [_cte])

# ---- facts whose user and date keys come from planned joins (J-08, J-09, J-11) --------
JOINED = {"m19j_fct_pull_requests_joined": "fct_pull_requests", "m20j_fct_issues_joined": "fct_issues",
          "m21j_fct_commits_joined": "fct_commits", "m22j_fct_stargazers_joined": "fct_stargazers"}
for _name, _attr in JOINED.items():
    register(_name, _model(_attr), f"SELECT * FROM {_attr}", [_attr])


_WAREHOUSES: dict[tuple, Warehouse] = {}


def warehouse_for(spark: SparkSession, sf_dir: str, with_reviews: bool = False, joined: bool = False) -> Warehouse:
    """One warehouse (lazy, analysed model plans) per session and data folder,
    shared by every query on them; nothing is cached as data."""
    key = (id(spark._jsparkSession), sf_dir.rstrip("/"), with_reviews, joined)
    wh = _WAREHOUSES.get(key)
    if wh is None or wh.spark is not spark:
        wh = _WAREHOUSES[key] = driver_warehouse(spark, sf_dir, with_reviews=with_reviews, date_join=joined,
                                                  users_join=joined)
    deal_by_size(spark, wh.input_bytes)
    return wh


# Models that a query saves on its way: all shuffles of a query stay until it ends, and
# these would hold several times what the largest of their steps does.
_MONTHS = ("comment_authors", "star_logins")
STEPS = {
    **dict.fromkeys(("q07_top_contributors", "q08_contributor_breakdown", "q12_engagement_trend", "q14_contributor_retention",
                     "m24_contributor_engagement", "m25_top_contributors"), _MONTHS),
    "m13_int_contributor_activity": ("comment_authors", "stg_users"),
    **dict.fromkeys(JOINED, ("comment_stats", "stg_users")),
    "t01_t05_mart_tests": ("comment_authors", "star_logins", "stg_users"),
    "t01_t02_source_staging_tests": ("comment_authors", "star_logins"),
    "m15r_int_pr_with_reviews_enabled": ("comment_stats", "reviews", "review_stats", "labelled_prs"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def make(name, fn):
        reviews = name in WITH_REVIEWS

        def run(spark, sf_dir):
            wh = warehouse_for(spark, sf_dir, reviews, name in JOINED)
            return fn(wh.in_steps(STEPS[name]) if name in STEPS else wh)
        return run
    return {name: make(name, fn) for name, (fn, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ENTRIES.items() if sql is not None}
