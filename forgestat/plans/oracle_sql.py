"""DuckDB oracle SQL for every registered query.

Each query states a model over the same adapter projection of the driver tables,
as CTEs, by another route than the Spark side: people and their activity from one
relation of acts, labels from the landed lists, foreign keys by scalar look-ups
in the dimensions, a release's predecessor by its place. Result types
are cast to the Spark types (SURVEY 1.4: BIGINT extracts -> INTEGER, HUGEINT
sums -> BIGINT, DECIMAL ratios -> DOUBLE); quantiles are ``quantile_disc``, which
both sides give exactly.
"""

from __future__ import annotations

from forgestat.params import DRIVER_PARAMS, DRIVER_SPINE_END_DAYS
from forgestat.sources.adapters import (API_ROOT, BOT_EVERY, LABELS, LANGUAGES, PRIORITY_LABELS,
                                        REVIEW_STATES, URL_ROOT)

LOAD_ID = DRIVER_PARAMS.load_id


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _labels_sql(col: str) -> str:
    def lab(n):
        lid, color, desc, default = LABELS[n]
        return (f"{{'id': CAST({lid} AS BIGINT), 'name': {_q(n)}, 'color': {_q(color)}, "
                f"'description': {_q(desc)}, 'default': {'true' if default else 'false'}}}")
    empty = ("CAST([] AS STRUCT(id BIGINT, name VARCHAR, color VARCHAR, description VARCHAR, "
             "\"default\" BOOLEAN)[])")
    whens = " ".join(f"WHEN {_q(p)} THEN [{', '.join(lab(n) for n in names)}]"
                     for p, names in PRIORITY_LABELS.items() if names)
    return f"CASE {col} {whens} ELSE {empty} END"


def _login(name: str, key: str) -> str:
    return f"{name} || CASE WHEN {key} % {BOT_EVERY} = 0 THEN '[bot]' ELSE '' END"


def _lang(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} % {len(LANGUAGES)} = {i} THEN {_q(n)}"
                              for i, n in enumerate(LANGUAGES)) + " END"


def _hours(a: str, b: str) -> str:
    return f"datediff('hour', {a}, {b})"


# name -> (sql, dependencies); definition order is a valid topological order.
CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, deps: list[str]) -> None:
    CTES[name] = (sql, deps)


# ---------------------------------------------------------------- adapters ----
cte("repo_map", """SELECT n.n_nationkey AS nationkey, r.r_regionkey AS regionkey, r.r_name AS _owner,
  n.n_name AS _repo FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""", [])
cte("people", f"""SELECT c_custkey AS user_id, {_login('c_name', 'c_custkey')} AS login,
  CASE WHEN c_custkey % {BOT_EVERY} = 0 THEN 'Bot' ELSE 'User' END AS user_type, c_nationkey AS nationkey
  FROM customer""", [])
cte("people_repo", """SELECT p.user_id, p.login, p.user_type, m._owner, m._repo
  FROM people p JOIN repo_map m ON p.nationkey = m.nationkey""", ["people", "repo_map"])
cte("suppliers", f"""SELECT s_suppkey AS supp_id, {_login('s_name', 's_suppkey')} AS supp_login,
  s_nationkey AS supp_nationkey FROM supplier""", [])
cte("order_repo", """SELECT o.o_orderkey, pr._owner, pr._repo FROM orders o
  JOIN people_repo pr ON o.o_custkey = pr.user_id""", ["people_repo"])
cte("orders_x", """SELECT o.*, pr.user_id, pr.login, pr.user_type, pr._owner, pr._repo,
  o.o_orderdate + to_minutes(CAST(o.o_orderkey % 1440 AS BIGINT)) AS created_at,
  ls.last_ship + to_minutes(CAST((o.o_orderkey * 7) % 1440 AS BIGINT)) AS end_at
  FROM orders o JOIN people_repo pr ON o.o_custkey = pr.user_id
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) ls
    ON o.o_orderkey = ls.l_orderkey""", ["people_repo"])
cte("orders_y", """SELECT *, CASE WHEN o_orderstatus = 'F' THEN end_at END AS merged_at,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN end_at END AS closed_at,
  greatest(created_at, coalesce(end_at, created_at)) AS updated_at FROM orders_x""", ["orders_x"])

_ISSUE_LIKE = """o_orderkey AS id, '{p}' || o_orderkey AS node_id, md5('{e}|' || o_orderkey) AS _row_id,
  o_orderkey AS number, 'Order ' || o_orderkey || ' (' || o_orderpriority || ')' AS title,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Placed by customer ' || o_custkey END AS body,
  CASE WHEN closed_at IS NOT NULL THEN 'closed' ELSE 'open' END AS state, false AS locked,
  login AS user__login, user_id AS user__id,
  CASE WHEN o_orderkey % 3 = 0 THEN login END AS assignee__login,
  CASE WHEN o_orderkey % 3 = 0 THEN user_id END AS assignee__id"""

cte("b_repositories", f"""SELECT CAST(m.nationkey AS BIGINT) AS id, 'R_' || m.nationkey AS node_id,
  md5('repositories|' || m.nationkey) AS _row_id, m._owner AS owner__login,
  CAST(m.regionkey AS BIGINT) AS owner__id, m._repo AS name, m._owner || '/' || m._repo AS full_name,
  'Activity of ' || m._repo AS description, false AS private, m.nationkey % 10 = 9 AS archived,
  false AS disabled, '{URL_ROOT}' || m._owner || '/' || m._repo AS html_url,
  CAST(DATE '1990-01-01' + m.nationkey AS TIMESTAMP) AS created_at,
  TIMESTAMP '2024-01-31 00:00:00' AS updated_at, TIMESTAMP '2024-01-30 12:00:00' AS pushed_at,
  CAST(m.nationkey AS BIGINT) * 1024 AS size,
  CAST(coalesce(c.n, 0) AS INTEGER) AS stargazers_count, CAST(coalesce(c.n, 0) AS INTEGER) AS watchers_count,
  CAST(coalesce(s.n, 0) AS INTEGER) AS forks_count, CAST((m.nationkey * 7) % 17 AS INTEGER) AS open_issues_count,
  {_lang('m.regionkey')} AS language, 'main' AS default_branch,
  CASE WHEN m.nationkey % 3 = 0 THEN 'MIT' WHEN m.nationkey % 3 = 1 THEN 'Apache-2.0' END AS license__name,
  true AS has_issues, m.nationkey % 2 = 0 AS has_projects, true AS has_wiki, false AS has_pages,
  true AS has_downloads,
  list_concat([lower(m._owner), 'nation-' || m.nationkey], coalesce(c.segs, [])) AS topics, m._owner, m._repo,
  '{LOAD_ID}' AS _load_id
  FROM repo_map m
  LEFT JOIN (SELECT c_nationkey, count(*) AS n, list_sort(list_distinct(list(lower(c_mktsegment)))) AS segs
             FROM customer GROUP BY c_nationkey) c ON m.nationkey = c.c_nationkey
  LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey) s ON m.nationkey = s.s_nationkey""",
    ["repo_map"])
cte("b_issues", f"""SELECT {_ISSUE_LIKE.format(p='I_', e='issues')},
  CAST(o_orderkey % 7 AS INTEGER) AS comments, created_at, updated_at, closed_at,
  CASE WHEN o_orderkey % 2 = 1 THEN '{URL_ROOT}' || _owner || '/' || _repo || '/pull/' || o_orderkey END
    AS pull_request__url,
  {_labels_sql('o_orderpriority')} AS labels, _owner, _repo, '{LOAD_ID}' AS _load_id
  FROM orders_y""", ["orders_y"])
cte("b_pull_requests", f"""SELECT {_ISSUE_LIKE.format(p='PR_', e='pull_requests')},
  o_orderkey % 9 = 0 AS draft, 'topic-' || o_orderkey AS head__ref, md5('head|' || o_orderkey) AS head__sha,
  'main' AS base__ref, md5('base|' || o_orderkey) AS base__sha,
  CASE WHEN merged_at IS NOT NULL THEN md5('merge|' || o_orderkey) END AS merge_commit_sha,
  created_at, updated_at, closed_at, merged_at, {_labels_sql('o_orderpriority')} AS labels,
  _owner, _repo, '{LOAD_ID}' AS _load_id
  FROM orders_y""", ["orders_y"])
cte("b_comments_landed", f"""SELECT l.l_orderkey * 100 + l.l_linenumber AS id,
  'IC_' || (l.l_orderkey * 100 + l.l_linenumber) AS node_id,
  md5('issue_comments|' || (l.l_orderkey * 100 + l.l_linenumber)) AS _row_id,
  '{API_ROOT}' || r._owner || '/' || r._repo || '/issues/' || l.l_orderkey AS issue_url,
  'part ' || l.l_partkey || ' from supplier ' || l.l_suppkey AS body,
  s.supp_login AS user__login, l.l_suppkey AS user__id,
  l.l_shipdate + to_minutes(CAST(l.l_partkey % 1440 AS BIGINT)) AS created_at,
  l.l_shipdate + to_minutes(CAST(l.l_partkey % 1440 AS BIGINT)) + to_seconds(CAST(l.l_suppkey % 3600 AS BIGINT))
    AS updated_at,
  r._owner, r._repo, '{LOAD_ID}' AS _load_id
  FROM lineitem l JOIN order_repo r ON l.l_orderkey = r.o_orderkey
  LEFT JOIN suppliers s ON l.l_suppkey = s.supp_id""", ["order_repo", "suppliers"])
cte("b_issue_comments", """SELECT * FROM b_comments_landed
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, body DESC NULLS LAST) = 1""",
    ["b_comments_landed"])
cte("b_commits", f"""SELECT md5(CAST(e.event_id AS VARCHAR)) AS sha, 'C_' || e.event_id AS node_id,
  md5('commits|' || md5(CAST(e.event_id AS VARCHAR))) AS _row_id,
  CASE WHEN e.event_type <> 'error' THEN pr.login END AS author__login,
  CASE WHEN e.event_type <> 'error' THEN e.user_id END AS author__id,
  pr.login AS committer__login, e.user_id AS committer__id,
  pr.login AS commit__author__name, 'user' || e.user_id || '@example.com' AS commit__author__email,
  e.ts AS commit__author__date, pr.login AS commit__committer__name,
  'user' || e.user_id || '@example.com' AS commit__committer__email,
  e.ts + to_minutes(CAST(e.event_id % 60 AS BIGINT)) AS commit__committer__date,
  e.event_type || ': ' || e.props AS commit__message, md5('tree|' || e.event_id) AS commit__tree__sha,
  CAST(e.event_id % 3 AS BIGINT) AS commit__comment_count, pr._owner, pr._repo, '{LOAD_ID}' AS _load_id
  FROM events e LEFT JOIN people_repo pr ON e.user_id = pr.user_id""", ["people_repo"])
cte("b_releases", f"""SELECT o.o_orderkey AS id, 'RE_' || o.o_orderkey AS node_id,
  md5('releases|' || o.o_orderkey) AS _row_id, pr.user_id AS author__id, 'v' || o.o_orderkey AS tag_name,
  'main' AS target_commitish, 'Release ' || o.o_orderkey AS name, o.o_orderkey % 20 = 0 AS draft,
  o.o_orderstatus = 'P' AS prerelease, 'Notes for ' || o.o_orderkey AS body, o.o_orderdate AS created_at,
  CASE WHEN o.o_orderkey % 25 = 0 THEN NULL ELSE o.o_orderdate END AS published_at,
  pr._owner, pr._repo, '{LOAD_ID}' AS _load_id
  FROM orders o JOIN people_repo pr ON o.o_custkey = pr.user_id""",
    ["people_repo"])
cte("b_stargazers", f"""SELECT f.starred_at, p.user_id, p.login AS user_login, p.user_type, m._owner, m._repo,
  '{LOAD_ID}' AS _load_id
  FROM (SELECT o.o_custkey, s.s_nationkey, min(l.l_shipdate) AS starred_at
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
        GROUP BY o.o_custkey, s.s_nationkey) f
  JOIN people p ON f.o_custkey = p.user_id JOIN repo_map m ON f.s_nationkey = m.nationkey""",
    ["people", "repo_map"])
cte("b_contributors", f"""SELECT pr.user_id, pr.login AS user_login, pr.user_type,
  CAST(count(*) AS INTEGER) AS contributions, pr._owner, pr._repo, '{LOAD_ID}' AS _load_id
  FROM orders o JOIN people_repo pr ON o.o_custkey = pr.user_id
  GROUP BY pr.user_id, pr.login, pr.user_type, pr._owner, pr._repo""", ["people_repo"])
_review_state = ("CASE " + " ".join(f"WHEN l.l_returnflag = {_q(k)} THEN {_q(v)}" for k, v in REVIEW_STATES.items())
                 + " ELSE 'COMMENTED' END")
cte("b_pr_reviews_landed", f"""SELECT l.l_orderkey * 100 + l.l_linenumber AS id, r._owner, r._repo,
  l.l_orderkey AS _pr_number,
  CASE WHEN l.l_suppkey % 10 = 0 THEN NULL ELSE l.l_suppkey END AS user__id, {_review_state} AS state,
  'review of part ' || l.l_partkey || ' flag ' || l.l_returnflag AS body, md5('review|' || (l.l_orderkey * 100 + l.l_linenumber)) AS commit_id,
  l.l_shipdate + to_minutes(CAST(l.l_partkey % 1440 AS BIGINT)) AS submitted_at, '{LOAD_ID}' AS _load_id,
  md5('pr_reviews|' || (l.l_orderkey * 100 + l.l_linenumber)) AS _row_id
  FROM lineitem l JOIN order_repo r ON l.l_orderkey = r.o_orderkey""", ["order_repo"])
cte("b_pr_reviews", """SELECT * FROM b_pr_reviews_landed
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY submitted_at DESC NULLS LAST, body DESC NULLS LAST,
                                                  user__id DESC NULLS LAST) = 1""", ["b_pr_reviews_landed"])

# ----------------------------------------------------------------- staging ----
cte("stg_repositories", """SELECT id AS repository_id, node_id AS repository_node_id,
  _row_id AS repository_dlt_id, owner__login AS owner_login, owner__id AS owner_id, name AS repository_name,
  full_name AS repository_full_name, description AS repository_description, private AS is_private,
  archived AS is_archived, disabled AS is_disabled, html_url AS repository_url,
  created_at::TIMESTAMP AS created_at, updated_at::TIMESTAMP AS updated_at, pushed_at::TIMESTAMP AS pushed_at,
  size AS repository_size_kb, stargazers_count, watchers_count, forks_count, open_issues_count,
  language AS primary_language, default_branch, license__name AS license_name,
  has_issues, has_projects, has_wiki, has_pages, has_downloads
  FROM b_repositories""", ["b_repositories"])
cte("stg_issues", """SELECT id AS issue_id, node_id AS issue_node_id, _row_id AS issue_dlt_id,
  CAST(number AS BIGINT) AS issue_number, _owner || '/' || _repo AS repository_full_name,
  title AS issue_title, body AS issue_body, state AS issue_state, locked AS is_locked,
  user__login AS author_login, user__id AS author_id, assignee__login AS assignee_login,
  assignee__id AS assignee_id, comments AS comments_count,
  created_at::TIMESTAMP AS created_at, updated_at::TIMESTAMP AS updated_at, closed_at::TIMESTAMP AS closed_at
  FROM b_issues""", ["b_issues"])
cte("stg_pull_requests", """SELECT id AS pull_request_id, node_id AS pull_request_node_id, _row_id AS pr_dlt_id,
  CAST(number AS BIGINT) AS pr_number, _owner AS repository_owner, _repo AS repository_name,
  _owner || '/' || _repo AS repository_full_name, title AS pr_title, body AS pr_body, state AS pr_state,
  locked AS is_locked, draft AS is_draft, user__login AS author_login, user__id AS author_id,
  assignee__login AS assignee_login, assignee__id AS assignee_id, head__ref AS head_ref, head__sha AS head_sha,
  base__ref AS base_ref, base__sha AS base_sha, merge_commit_sha,
  CASE WHEN merged_at IS NOT NULL THEN true ELSE false END AS is_merged,
  created_at::TIMESTAMP AS created_at, updated_at::TIMESTAMP AS updated_at, closed_at::TIMESTAMP AS closed_at,
  merged_at::TIMESTAMP AS merged_at
  FROM b_pull_requests""", ["b_pull_requests"])
cte("stg_issue_comments", r"""SELECT id AS comment_id, node_id AS comment_node_id,
  CAST(regexp_extract(issue_url, '/issues/(\d+)$', 1) AS BIGINT) AS issue_number,
  _owner || '/' || _repo AS repository_full_name, body AS comment_body, CAST(length(body) AS BIGINT) AS comment_length,
  user__login AS author_login, user__id AS author_id,
  created_at::TIMESTAMP AS created_at, updated_at::TIMESTAMP AS updated_at
  FROM b_issue_comments""", ["b_issue_comments"])
cte("stg_commits", """SELECT sha AS commit_sha, node_id AS commit_node_id,
  _owner || '/' || _repo AS repository_full_name, author__login AS author_login, author__id AS author_id,
  committer__login AS committer_login, committer__id AS committer_id,
  commit__author__name AS commit_author_name, commit__author__email AS commit_author_email,
  commit__committer__name AS committer_name, commit__committer__email AS committer_email,
  commit__message AS commit_message, CAST(length(commit__message) AS BIGINT) AS message_length,
  commit__tree__sha AS tree_sha, commit__comment_count AS comment_count,
  commit__author__date::TIMESTAMP AS commit_date, commit__committer__date::TIMESTAMP AS committer_date
  FROM b_commits""", ["b_commits"])
cte("stg_releases", """SELECT id AS release_id,
  md5(coalesce(CAST(_owner AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
      coalesce(CAST(_repo AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS repository_key,
  author__id AS author_user_id, _owner AS repository_owner, _repo AS repository_name,
  _owner || '/' || _repo AS repository_full_name, tag_name, target_commitish, name AS release_name,
  draft AS is_draft, prerelease AS is_prerelease, body AS release_notes,
  created_at::TIMESTAMP AS created_at, published_at::TIMESTAMP AS published_at,
  _load_id AS _dlt_load_id, _row_id AS _dlt_id
  FROM b_releases""", ["b_releases"])
cte("stg_stargazers", """SELECT user_id, user_login, _owner || '/' || _repo AS repository_full_name,
  starred_at::TIMESTAMP AS starred_at FROM b_stargazers""", ["b_stargazers"])
for _child, _parent, _arr in (("c_issue_labels", "b_issues", "labels"), ("c_pr_labels", "b_pull_requests", "labels"),
                              ("c_repository_topics", "b_repositories", "topics")):
    cte(_child, f"""SELECT _row_id AS _parent_row_id, CAST(unnest(range(len({_arr}))) AS BIGINT) AS _list_idx,
  unnest({_arr}) AS _elem FROM {_parent}""", [_parent])
_LABEL_COLS = """_list_idx AS label_position, struct_extract(_elem, 'id') AS label_id,
  struct_extract(_elem, 'name') AS label_name, struct_extract(_elem, 'color') AS label_color,
  struct_extract(_elem, 'description') AS label_description, struct_extract(_elem, 'default') AS is_default_label"""
cte("stg_issue_labels", f"SELECT _parent_row_id AS issue_dlt_id, {_LABEL_COLS} FROM c_issue_labels", ["c_issue_labels"])
cte("stg_pr_labels", f"SELECT _parent_row_id AS pr_dlt_id, {_LABEL_COLS} FROM c_pr_labels", ["c_pr_labels"])
cte("stg_repository_topics", """SELECT _parent_row_id AS repository_dlt_id, _list_idx AS topic_position,
  _elem AS topic_name FROM c_repository_topics""", ["c_repository_topics"])
cte("stg_pr_reviews", """SELECT id AS review_id,
  md5(coalesce(CAST(_owner AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
      coalesce(CAST(_repo AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS repository_key,
  CAST(_pr_number AS BIGINT) AS pull_request_number, user__id AS reviewer_user_id,
  _owner AS repository_owner, _repo AS repository_name, state AS review_state, body AS review_body, commit_id,
  submitted_at::TIMESTAMP AS submitted_at, _load_id AS _dlt_load_id, _row_id AS _dlt_id
  FROM b_pr_reviews WHERE user__id IS NOT NULL""", ["b_pr_reviews"])
# What people do: kind, table, prefix of the person's columns, instant, id (a star is no activity).
_ACTS = (("issue_created", "stg_issues", "author", "created_at", "issue_id"),
         ("pr_created", "stg_pull_requests", "author", "created_at", "pull_request_id"),
         ("comment_created", "stg_issue_comments", "author", "created_at", "comment_id"),
         ("commit_created", "stg_commits", "author", "commit_date", "commit_sha"),
         ("starred", "stg_stargazers", "user", "starred_at", "NULL"))
cte("acts", " UNION ALL ".join(
    f"(SELECT {_q(kind)} AS activity_type, {who}_id AS user_id, {who}_login AS user_login, repository_full_name, "
    f"{at} AS activity_at, CAST({key} AS VARCHAR) AS activity_id FROM {source})" for kind, source, who, at, key in _ACTS),
    [source for _, source, *_ in _ACTS])
# 'bot' anywhere covers the bracketed suffix and the bots whose names end so
cte("stg_users", """SELECT user_id, user_login, coalesce(regexp_matches(lower(user_login), 'bot|^(github-actions|renovate)$'), false) AS is_bot
  FROM (SELECT user_id, min(user_login) AS user_login FROM acts GROUP BY ALL HAVING user_id IS NOT NULL)""", ["acts"])

# ------------------------------------------------------------ intermediate ----
_GRAINS = {"day": "date", "week": "week", "month": "month", "year": "year"}
cte("int_contributor_activity", f"""SELECT user_id, acts.user_login, repository_full_name, activity_type, activity_at, activity_id, is_bot,
    {", ".join(f"date_trunc('{unit}', activity_at) AS activity_{name}" for unit, name in _GRAINS.items())}
  FROM acts INNER JOIN stg_users USING (user_id) WHERE activity_type <> 'starred'""", ["acts", "stg_users"])
# discussion of an issue or a pull request, found by (repository, number); labels straight from the landed lists
cte("talk", """SELECT repository_full_name AS repo, issue_number AS number, count(*) AS n, min(created_at) AS since
  FROM stg_issue_comments GROUP BY ALL""", ["stg_issue_comments"])
for _name, _landed in (("issue_tags", "b_issues"), ("pr_tags", "b_pull_requests")):
    cte(_name, f"""SELECT _row_id, coalesce(len(labels), 0) AS n, list_transform(labels, lambda x: lower(x.name)) AS names
  FROM {_landed}""", [_landed])
cte("int_issue_lifecycle", f"""SELECT issue_id, issue_number, repository_full_name, issue_title, issue_state, author_login, author_id,
    created_at, updated_at, closed_at, ifnull(talk.n, 0) AS comment_count, since AS first_comment_at,
    {_hours('created_at', 'closed_at')} AS time_to_close_hours, {_hours('created_at', 'since')} AS time_to_first_response_hours,
    closed_at IS NOT NULL AS is_closed, assignee_id IS NOT NULL AS is_assigned, tags.n AS label_count,
    ifnull(list_contains(names, 'bug'), false) AS is_bug,
    ifnull(list_has_any(names, ['enhancement', 'feature']), false) AS is_enhancement
  FROM issue_tags AS tags INNER JOIN stg_issues ON issue_dlt_id = tags._row_id
    LEFT JOIN talk ON (repo, number) = (repository_full_name, issue_number)""", ["stg_issues", "issue_tags", "talk"])
_VERDICTS = {"approval_count": "APPROVED", "changes_requested_count": "CHANGES_REQUESTED", "comment_review_count": "COMMENTED"}
cte("review_stats", f"""SELECT repository_owner, repository_name, pull_request_number, n AS review_count, people AS unique_reviewers,
    low AS first_review_at, high AS last_review_at,
    {", ".join(f"CAST(ifnull(states[{_q(v)}], 0) AS BIGINT) AS {c}" for c, v in _VERDICTS.items())}
  FROM (SELECT repository_owner, repository_name, pull_request_number, count(*) AS n, len(list_distinct(list(reviewer_user_id))) AS people,
      min(submitted_at) AS low, max(submitted_at) AS high, histogram(review_state) AS states
    FROM stg_pr_reviews GROUP BY ALL)""", ["stg_pr_reviews"])
cte("no_reviews", "SELECT * FROM review_stats WHERE false", ["review_stats"])


def _pull_requests(reviews: str) -> str:
    def count(c: str) -> str:
        return f"ifnull({c}, 0) AS {c}"
    return f"""SELECT pull_request_id, pr_number, repository_full_name, pr_title, pr_state, is_merged, is_draft, author_login, author_id,
    created_at, updated_at, closed_at, merged_at, {count('review_count')}, {count('unique_reviewers')},
    first_review_at, last_review_at, {", ".join(map(count, _VERDICTS))}, ifnull(talk.n, 0) AS comment_count, since AS first_comment_at,
    {_hours('created_at', 'first_review_at')} AS time_to_first_review_hours,
    {_hours('created_at', 'since')} AS time_to_first_comment_hours, {_hours('created_at', 'merged_at')} AS time_to_merge_hours,
    if(merged_at IS NULL, {_hours('created_at', 'closed_at')}, NULL) AS time_to_close_without_merge_hours,
    closed_at IS NOT NULL AS is_closed, closed_at IS NOT NULL AND merged_at IS NULL AS is_closed_without_merge, tags.n AS label_count
  FROM pr_tags AS tags INNER JOIN stg_pull_requests AS p ON pr_dlt_id = tags._row_id
    LEFT JOIN talk ON (repo, number) = (repository_full_name, pr_number)
    LEFT JOIN {reviews} AS r ON (r.repository_owner, r.repository_name, pull_request_number)
      = (p.repository_owner, p.repository_name, pr_number)"""


for _name, _reviews in (("int_pr_with_reviews", "no_reviews"), ("int_pr_with_reviews_on", "review_stats")):
    cte(_name, _pull_requests(_reviews), ["stg_pull_requests", "pr_tags", "talk", _reviews])

# ------------------------------------------------------------------- marts ----
def _skey(*cols: str) -> str:
    parts = " || '-' || ".join(f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in cols)
    return f"md5({parts})"


cte("dim_dates", f"""SELECT CAST(d AS DATE) AS date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
  CAST(extract(year FROM d) AS INTEGER) AS year, CAST(extract(quarter FROM d) AS INTEGER) AS quarter,
  CAST(extract(month FROM d) AS INTEGER) AS month, CAST(extract(week FROM d) AS INTEGER) AS week_of_year,
  CAST(extract(dayofweek FROM d) AS INTEGER) AS day_of_week, CAST(extract(dayofyear FROM d) AS INTEGER) AS day_of_year,
  strftime(d, '%B') AS month_name, strftime(d, '%A') AS day_name,
  CASE WHEN extract(dayofweek FROM d) IN (0, 6) THEN true ELSE false END AS is_weekend,
  CASE WHEN extract(month FROM d) IN (12, 1, 2) THEN true ELSE false END AS is_winter,
  CASE WHEN extract(month FROM d) IN (3, 4, 5) THEN true ELSE false END AS is_spring,
  CASE WHEN extract(month FROM d) IN (6, 7, 8) THEN true ELSE false END AS is_summer,
  CASE WHEN extract(month FROM d) IN (9, 10, 11) THEN true ELSE false END AS is_fall
  FROM (SELECT CAST(range AS DATE) AS d FROM range(
          (SELECT CAST(min(CAST(o_orderdate AS DATE)) AS TIMESTAMP) FROM orders),
          (SELECT CAST(max(CAST(ts AS DATE)) + {DRIVER_SPINE_END_DAYS} AS TIMESTAMP) FROM events),
          INTERVAL 1 DAY)) s""", [])
cte("dim_repositories", f"""SELECT {_skey('repository_id')} AS repo_key, repository_id, repository_full_name,
  repository_name, owner_login, owner_id, repository_description, repository_url, primary_language,
  default_branch, license_name, stargazers_count, watchers_count, forks_count, open_issues_count,
  repository_size_kb, has_issues, has_projects, has_wiki, has_pages, has_downloads, is_private, is_archived,
  is_disabled, created_at, updated_at, pushed_at FROM stg_repositories""", ["stg_repositories"])
cte("dim_users", f"SELECT {_skey('user_id')} AS user_key, user_id, user_login, is_bot FROM stg_users", ["stg_users"])
# dimension -> its key, and the condition under which the dimension's row belongs to the value
_DIMENSIONS = {"repo": ("repo_key", "dim_repositories", "repository_full_name = {}"),
               "user": ("user_key", "dim_users", "user_id = {}"),
               "day": ("date_key", "dim_dates", "date = CAST({} AS DATE)")}


def fact(name: str, source: str, key: tuple[str, list[str]], own: str, foreign: dict[str, tuple[str, str]], rest: str) -> None:
    """A fact: surrogate key, own ids, one scalar look-up per foreign key (an
    error if a dimension holds a value twice), and the columns that it keeps."""
    def look_up(dimension: str, column: str) -> str:
        found, relation, belongs = _DIMENSIONS[dimension]
        return f"(SELECT {found} FROM {relation} AS d WHERE d.{belongs.format('f.' + column)})"
    keys = ",\n    ".join(f"{look_up(*where)} AS {c}" for c, where in foreign.items())
    cte(name, f"SELECT {_skey(*key[1])} AS {key[0]}, {own + ', ' if own else ''}{keys},\n    {rest}\n  FROM {source} AS f",
        [source, *sorted({_DIMENSIONS[d][1] for d, _ in foreign.values()})])


_BY = {"repo_key": ("repo", "repository_full_name"), "author_key": ("user", "author_id")}
fact("fct_pull_requests", "int_pr_with_reviews", ("pr_key", ["pull_request_id"]), "pull_request_id, pr_number",
     _BY | {f"{x}_date_key": ("day", f"{x}_at") for x in ("created", "merged", "closed")},
     "pr_title, pr_state, is_merged, is_draft, is_closed, is_closed_without_merge, label_count, comment_count, "
     "time_to_first_comment_hours, time_to_merge_hours, time_to_close_without_merge_hours, "
     "created_at, updated_at, closed_at, merged_at")
fact("fct_issues", "int_issue_lifecycle", ("issue_key", ["issue_id"]), "issue_id, issue_number",
     _BY | {f"{x}_date_key": ("day", f"{x}_at") for x in ("created", "closed")},
     "issue_title, issue_state, is_closed, is_assigned, label_count, is_bug, is_enhancement, comment_count, "
     "time_to_close_hours, time_to_first_response_hours, created_at, updated_at, closed_at, first_comment_at")
fact("fct_commits", "stg_commits", ("commit_key", ["commit_sha"]), "commit_sha", _BY | {"commit_date_key": ("day", "commit_date")},
     "commit_message, message_length, commit_author_name, commit_author_email, comment_count, commit_date, committer_date")
fact("fct_stargazers", "stg_stargazers", ("stargazer_key", ["user_id", "repository_full_name"]), "",
     {"repo_key": _BY["repo_key"], "user_key": ("user", "user_id"), "starred_date_key": ("day", "starred_at")}, "starred_at")

# ----------------------------------------------------------------- metrics ----
# Periods are rows of a small table, so that each metric is stated once for both grains.
cte("merged_hours", """SELECT g.period_type, f.repo_key, d.year, d.date, f.time_to_merge_hours AS h,
    CASE WHEN g.period_type = 'weekly' THEN d.week_of_year ELSE d.month END AS period_number
  FROM dim_dates AS d INNER JOIN fct_pull_requests AS f ON d.date_key = f.created_date_key,
    (VALUES ('weekly'), ('monthly')) AS g(period_type) WHERE f.is_merged AND f.time_to_merge_hours >= 0""",
    ["dim_dates", "fct_pull_requests"])
cte("pr_cycle_time", """SELECT x.period_type, repository_name, repository_full_name, x.year, x.period_number,
    x.first_day AS period_start_date, x.n AS merged_pr_count, x.mean AS avg_hours_to_merge, x.mid AS median_hours_to_merge,
    x.low AS min_hours_to_merge, x.high AS max_hours_to_merge, x.q[1] AS p25_hours_to_merge, x.q[2] AS p75_hours_to_merge,
    x.q[3] AS p90_hours_to_merge, x.mean / 24 AS avg_days_to_merge, x.mid / 24 AS median_days_to_merge,
    x.q[3] / 24 AS p90_days_to_merge
  FROM dim_repositories INNER JOIN (
    SELECT period_type, repo_key, year, period_number, count(h) AS n, min(date) AS first_day, avg(h) AS mean, median(h) AS mid,
      min(h) AS low, max(h) AS high, quantile_disc(h, [0.25, 0.75, 0.90]) AS q
    FROM merged_hours GROUP BY ALL) AS x USING (repo_key)""", ["merged_hours", "dim_repositories"])
_KINDS = (("commit", "committers"), ("pr", "pr_creators"), ("issue", "issue_creators"), ("comment", "commenters"))
cte("user_months", f"""SELECT repository_full_name AS repo, user_id, date_trunc('month', activity_at) AS m, count(*) AS n,
    {", ".join(f"count(*) FILTER (WHERE activity_type = '{k}_created') AS n_{k}" for k, _ in _KINDS)},
    m IS NOT NULL AND row_number() OVER (PARTITION BY repo, user_id ORDER BY m) = 1 AS fresh
  FROM int_contributor_activity WHERE NOT is_bot GROUP BY repo, user_id, m""", ["int_contributor_activity"])
cte("contributor_engagement", f"""SELECT *, CAST(total_activities AS DOUBLE) / unique_contributors AS activities_per_contributor,
    100.0 * CAST(returning_contributors AS DOUBLE) / unique_contributors AS returning_contributor_pct
  FROM (SELECT repo AS repository_full_name, date_trunc('year', m) AS year, CAST(month(m) AS INTEGER) AS month,
      m AS month_start_date, count(*) AS unique_contributors, CAST(sum(n) AS BIGINT) AS total_activities,
      count(*) FILTER (WHERE fresh) AS new_contributors, count(*) FILTER (WHERE NOT fresh) AS returning_contributors,
      {", ".join(f"count(*) FILTER (WHERE n_{k} > 0) AS {who}, CAST(sum(n_{k}) AS BIGINT) AS {k}_count" for k, who in _KINDS)}
    FROM user_months GROUP BY repo, m)""", ["user_months"])
cte("top_contributors", """SELECT repo AS repository_full_name, date_trunc('year', m) AS year, CAST(month(m) AS INTEGER) AS month,
    user_login, user_id, activity_count, activity_type_count, place AS contributor_rank
  FROM (SELECT *, row_number() OVER (PARTITION BY repo, m ORDER BY activity_count DESC, user_id, user_login NULLS LAST) AS place
    FROM (SELECT repository_full_name AS repo, date_trunc('month', activity_at) AS m, user_id, user_login,
        count(*) AS activity_count, count(DISTINCT activity_type) AS activity_type_count
      FROM int_contributor_activity WHERE NOT is_bot GROUP BY ALL)) WHERE place <= 10""", ["int_contributor_activity"])
cte("release_chain", """SELECT n.*, d.repository_name,
    row_number() OVER (PARTITION BY n.repository_full_name ORDER BY n.published_at, n.release_id) AS place
  FROM stg_releases AS n INNER JOIN dim_repositories AS d USING (repository_full_name)
  WHERE NOT n.is_draft AND n.published_at IS NOT NULL""", ["stg_releases", "dim_repositories"])
cte("release_intervals_rows", """SELECT a.repository_full_name, a.repository_name, a.release_id, a.tag_name, a.release_name,
    a.is_prerelease, a.is_draft, a.published_at, a.created_at, b.published_at AS previous_release_at,
    CAST(a.published_at AS DATE) - CAST(b.published_at AS DATE) AS days_since_last_release
  FROM release_chain AS a LEFT JOIN release_chain AS b
    ON b.repository_full_name = a.repository_full_name AND b.place = a.place - 1""", ["release_chain"])
cte("release_velocity", """SELECT p AS period_type, repository_name, repository_full_name, CAST(year(start) AS INTEGER) AS year,
    CASE WHEN p = 'monthly' THEN CAST(month(start) AS INTEGER) END AS period_number,
    CASE WHEN p = 'quarterly' THEN CAST(quarter(start) AS INTEGER) END AS quarter, start AS period_start_date,
    n AS release_count, stable AS stable_release_count, CASE WHEN p = 'monthly' THEN pre END AS prerelease_count,
    mean AS avg_days_between_releases, mid AS median_days_between_releases,
    CASE WHEN p = 'monthly' THEN low END AS min_days_between_releases, CASE WHEN p = 'monthly' THEN high END AS max_days_between_releases,
    CAST(n AS DOUBLE) / months AS releases_per_period
  FROM (SELECT p, months, repository_name, repository_full_name,
      CASE WHEN p = 'monthly' THEN date_trunc('month', published_at) ELSE date_trunc('quarter', published_at) END AS start,
      count(*) AS n, count(*) FILTER (WHERE NOT is_prerelease) AS stable, count(*) FILTER (WHERE is_prerelease) AS pre,
      avg(days_since_last_release) AS mean, median(days_since_last_release) AS mid, min(days_since_last_release) AS low,
      max(days_since_last_release) AS high
    FROM release_intervals_rows, (VALUES ('monthly', 1), ('quarterly', 3)) AS periods(p, months) GROUP BY ALL)""",
    ["release_intervals_rows"])
cte("commits_per_release", """SELECT c.repository_full_name, c.commit_month, count(*) AS commit_count
  FROM (SELECT repository_full_name, date_trunc('month', commit_date) AS commit_month FROM stg_commits) AS c GROUP BY ALL""",
    ["stg_commits"])


def compose(final: str, deps: list[str]) -> str:
    """WITH clause holding the transitive dependencies of ``deps``."""
    need: set[str] = set()

    def visit(n: str) -> None:
        if n in need:
            return
        for d in CTES[n][1]:
            visit(d)
        need.add(n)

    for d in deps:
        visit(d)
    ordered = [n for n in CTES if n in need]
    body = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in ordered)
    return f"WITH {body}\n{final}"
