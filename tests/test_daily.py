"""Two daily runs over landed JSON: cursors, merges, appends, replaces, then
the model build and the declared tests."""

import datetime as dt
import json
import os

import pytest

from forgestat.params import WarehouseParams
from forgestat.plans.daily import Repository, daily_run, load_entity
from forgestat.sources.bronze import BronzeTable
from forgestat.streaming.ingest_stream import cursor_log


def _land(root, entity, owner, repo, name, recs):
    d = root / entity / f"_owner={owner}" / f"_repo={repo}"
    d.mkdir(parents=True, exist_ok=True)
    (d / name).write_text("\n".join(json.dumps(r) for r in recs) + "\n")


def _user(i, login=None):
    return {"login": login or f"user{i}", "id": i, "type": "User"}


def _batch(root, day, issue_title, extra_comment):
    ts = f"2026-01-{day:02d}T10:00:00Z"
    _land(root, "repositories", "acme", "app", f"r{day}.json", [{
        "id": 1, "node_id": "R1", "owner": _user(100, "acme"), "name": "app", "full_name": "acme/app",
        "description": f"day {day}", "private": False, "archived": False, "html_url": "https://x/acme/app",
        "created_at": "2025-01-01T00:00:00Z", "stargazers_count": day, "topics": ["db", "sql"],
        "license": {"name": "MIT"}, "has_issues": True}])
    _land(root, "issues", "acme", "app", f"i{day}.json", [
        {"id": 10, "number": 1, "title": issue_title, "state": "closed", "user": _user(1),
         "created_at": "2026-01-01T09:30:00Z", "updated_at": ts, "closed_at": "2026-01-02T10:15:00Z",
         "labels": [{"id": 1, "name": "Bug", "default": True}]},
        {"id": 11, "number": 2, "title": "pr as issue", "state": "open", "user": _user(2, "x[bot]"),
         "created_at": "2026-01-01T09:00:00Z", "updated_at": "2026-01-01T09:00:00Z",
         "pull_request": {"url": "https://x/pull/2"}, "labels": []}])
    _land(root, "pull_requests", "acme", "app", f"p{day}.json", [
        {"id": 20, "number": 2, "title": "pr", "state": "closed", "draft": False, "user": _user(2, "x[bot]"),
         "created_at": "2026-01-01T09:00:00Z", "updated_at": ts, "closed_at": "2026-01-01T12:00:00Z",
         "merged_at": "2026-01-01T12:00:00Z", "labels": [{"id": 2, "name": "feature"}]}])
    comments = [{"id": 30, "issue_url": "https://api.x/repos/acme/app/issues/1", "body": "first",
                 "user": _user(3), "created_at": "2026-01-01T11:00:00Z", "updated_at": "2026-01-01T11:00:00Z"}]
    if extra_comment:
        comments.append({"id": 31, "issue_url": "https://api.x/repos/acme/app/issues/2", "body": "late",
                         "user": _user(1), "created_at": ts, "updated_at": ts})
    _land(root, "issue_comments", "acme", "app", f"c{day}.json", comments)
    _land(root, "commits", "acme", "app", f"k{day}.json", [
        {"sha": f"s{day}", "author": _user(1), "committer": _user(1),
         "commit": {"author": {"name": "U", "email": "u@x", "date": ts},
                    "committer": {"name": "U", "email": "u@x", "date": ts}, "message": "m"}}])
    _land(root, "releases", "acme", "app", f"rel{day}.json", [
        {"id": 40 + day, "tag_name": f"v{day}", "name": f"v{day}", "draft": False, "prerelease": False,
         "created_at": ts, "published_at": ts, "author": _user(1)}])
    _land(root, "stargazers", "acme", "app", f"s{day}.json", [{"starred_at": ts, "user": _user(4)}])
    _land(root, "contributors", "acme", "app", f"co{day}.json", [{"id": 1, "login": "user1", "type": "User",
                                                                 "contributions": day}])


def test_two_daily_runs(spark, tmp_path):
    params = WarehouseParams(date_spine_start=dt.date(2025, 12, 1), date_spine_end=dt.date(2026, 2, 1))
    land1, land2 = tmp_path / "l1", tmp_path / "l2"
    bronze, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    _batch(land1, 2, "first title", extra_comment=False)
    r1 = daily_run(spark, str(land1), bronze, out + "/1", "2026-01-02T00", params)
    assert r1["bronze_rows"]["issues"] == 2 and r1["tables"]["fct_pull_requests"] == 1
    _batch(land2, 3, "second title", extra_comment=True)
    r2 = daily_run(spark, str(land2), bronze, out + "/2", "2026-01-03T00", params)
    b = r2["bronze_rows"]
    assert b["issues"] == 2 and b["issue_comments"] == 2 and b["commits"] == 2 and b["releases"] == 2
    assert b["stargazers"] == 2 and b["repositories"] == 1 and b["contributors"] == 1
    issues = {r["id"]: r["title"] for r in BronzeTable(spark, f"{bronze}/issues").read().collect()}
    assert issues[10] == "second title"
    fct = {r["issue_id"]: r for r in spark.read.parquet(out + "/2/fct_issues").collect()}
    assert fct[10]["time_to_close_hours"] == 25 and fct[10]["is_bug"] and fct[10]["comment_count"] == 1
    assert r2["tests"]["fct_pull_requests.not_null.repo_key"] == 0
    assert r2["metrics"]["pr_cycle_time"] == 2         # one weekly and one monthly row
    cur = {r["entity"]: r["last_value"] for r in cursor_log(spark, bronze).collect()}
    assert cur["issues"] == dt.datetime(2026, 1, 3, 10, 0)
    assert r2["freshness"]["issues"] == "error" and r2["landed"]["issues"]["files"] == 1


def _files(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def _issue(i, updated, title="t"):
    return {"id": i, "number": i, "title": title, "state": "open", "user": _user(i), "created_at": "2026-01-01T00:00:00Z",
            "updated_at": updated, "labels": []}


def test_second_run_reads_only_the_new_file(spark, tmp_path):
    land, bronze = tmp_path / "landing", tmp_path / "bronze"
    for repo in ("a", "b", "007"):
        _land(land, "issues", "acme", repo, "one.json", [_issue(ord(repo[0]), "2026-01-02T00:00:00Z")])
    stats, _ = load_entity(spark, str(land), str(bronze), "issues", "l1")
    assert stats == {"files": 3, "lines": 3, "quarantined": 0, "rows": 3, "null_cursors": 0}
    before = _files(bronze / "issues")
    # a file older than those already read, with a later update, an old one and one without an update time
    _land(land, "issues", "acme", "b", "two.json", [_issue(98, "2026-01-03T00:00:00Z", "new"), _issue(500, "2025-12-01T00:00:00Z"),
                                                    _issue(501, None)])
    os.utime(land / "issues" / "_owner=acme" / "_repo=b" / "two.json", (0, 0))
    stats, table = load_entity(spark, str(land), str(bronze), "issues", "l2")
    assert stats == {"files": 1, "lines": 3, "quarantined": 0, "rows": 2, "null_cursors": 1}
    after = _files(bronze / "issues")
    kept = {p for p in before if "_repo=b" not in str(p)}
    assert kept and all(after.get(p) == before[p] for p in kept)          # untouched repositories keep their files
    assert not any(p in after for p in before if "_repo=b" in str(p))
    got = {(r["_repo"], r["id"]): r["title"] for r in table.collect()}
    assert got == {("a", 97): "t", ("007", 48): "t", ("b", 98): "new", ("b", 501): "t"}
    stats, _ = load_entity(spark, str(land), str(bronze), "issues", "l3")
    assert not stats or stats["files"] == 0


def test_append_leaves_old_files(spark, tmp_path):
    land, bronze = tmp_path / "landing", tmp_path / "bronze"
    star = lambda u, t: {"starred_at": t, "user": _user(u)}
    _land(land, "stargazers", "o", "r", "one.json", [star(1, "2026-01-02T10:00:00Z"), star(2, "2026-01-03T10:00:00Z")])
    load_entity(spark, str(land), str(bronze), "stargazers", "l1", modes="declared")
    before = _files(bronze / "stargazers")
    _land(land, "stargazers", "o", "r", "two.json", [star(2, "2026-01-03T10:00:00Z"), star(3, "2026-01-03T11:00:00Z"),
                                                     star(3, "2026-01-03T11:00:00Z"), star(4, None)])
    _, table = load_entity(spark, str(land), str(bronze), "stargazers", "l2", modes="declared")
    after = _files(bronze / "stargazers")
    assert all(after.get(p) == t for p, t in before.items()) and len(after) > len(before)
    assert sorted(r["user_id"] for r in table.collect()) == [1, 2, 3, 4]
    _land(land, "stargazers", "o", "r", "three.json", [star(3, "2026-01-03T11:00:00Z"), star(4, None)])
    load_entity(spark, str(land), str(bronze), "stargazers", "l3", modes="declared")
    again = _files(bronze / "stargazers")
    assert [r["user_id"] for r in table.filter("starred_at is null").collect()] == [4]
    assert all(again.get(p) == t for p, t in before.items())


def test_replace_touches_its_repositories(spark, tmp_path):
    land, bronze = tmp_path / "landing", tmp_path / "bronze"
    person = lambda i, n: {"id": i, "login": f"u{i}", "type": "User", "contributions": n}
    _land(land, "contributors", "o", "a", "1.json", [person(1, 5), person(2, 6)])
    _land(land, "contributors", "o", "b", "1.json", [person(1, 7)])
    load_entity(spark, str(land), str(bronze), "contributors", "l1", modes="declared")
    before = {p: t for p, t in _files(bronze / "contributors").items() if "_repo=b" in str(p)}
    _land(land, "contributors", "o", "a", "2.json", [person(3, 1)])
    _, table = load_entity(spark, str(land), str(bronze), "contributors", "l2", modes="declared")
    assert sorted((r["_repo"], r["user_id"]) for r in table.collect()) == [("a", 3), ("b", 1)]
    after = _files(bronze / "contributors")
    assert before and all(after.get(p) == t for p, t in before.items())


def test_reviews_of_every_answer(spark, tmp_path):
    land, bronze = tmp_path / "landing", tmp_path / "bronze"
    review = lambda i: {"id": i, "user": _user(7), "state": "APPROVED", "submitted_at": "2026-01-02T00:00:00Z"}
    _land(land, "pr_review_responses", "o", "r", "1.json", [
        {"_pr_number": 1, "status": 200, "reviews": [review(1), review(2)]}, {"_pr_number": 2, "status": 403},
        {"_pr_number": 3, "status": 404, "reviews": []}, {"_pr_number": 4, "status": 200, "reviews": []}])
    _land(land, "pr_reviews", "o", "r", "1.json", [{**review(9), "_pr_number": 5}])
    stats, table = load_entity(spark, str(land), str(bronze), "pr_reviews", "l1", modes="declared")
    assert sorted((r["_pr_number"], r["id"]) for r in table.collect()) == [(1, 1), (1, 2), (5, 9)] and stats["rows"] == 3
    access = spark.read.parquet(f"{bronze}/_review_access").collect()
    assert [(r.readable_pull_requests, r.forbidden_count, r.not_found_count, r.accessible_count) for r in access] == [(2, 1, 1, 2)]
    _land(land, "pr_review_responses", "o", "r", "2.json", [{"_pr_number": 6, "status": 500}])
    with pytest.raises(Exception, match="status 500"):
        load_entity(spark, str(land), str(bronze), "pr_reviews", "l2", modes="declared")


def test_configured_repositories(spark, tmp_path):
    land, bronze = tmp_path / "landing", tmp_path / "bronze"
    for k, repo in enumerate(("a", "b", "c")):
        _land(land, "issues", "o", repo, "1.json", [_issue(10 * k + 1, "2026-01-02T00:00:00Z"), _issue(10 * k + 2, "2026-02-02T00:00:00Z")])
    listed = (Repository("o", "a", "2026-02-01 00:00:00"), Repository("o", "b", enabled=False))
    _, table = load_entity(spark, str(land), str(bronze), "issues", "l1", repositories=listed)
    assert sorted((r["_repo"], r["id"]) for r in table.collect()) == [("a", 2), ("c", 21), ("c", 22)]


def test_undeclared_fields_are_kept(spark, tmp_path):
    """Fields beyond the declared schema stay beside the row and become typed
    columns later; files of an earlier schema and list lines read on."""
    from forgestat.sources.landing import EXTRA, with_fields
    land, bronze = tmp_path / "land", str(tmp_path / "bronze")

    def issue(k, **more):
        return {"id": k, "number": k, "title": f"t{k}", "user": {"login": "u", "id": 1, "type": "User"},
                "created_at": "2026-01-01T00:00:00Z", "updated_at": "2026-01-02T00:00:00Z", **more}
    _land(land, "issues", "acme", "app", "a.json", [issue(1)])
    load_entity(spark, str(land), bronze, "issues", "1")
    # what an earlier schema has left: files without the column
    old = spark.read.parquet(f"{bronze}/issues").drop("_extra").collect()
    columns = [f for f in spark.read.parquet(f"{bronze}/issues").schema if f.name != "_extra"]
    from pyspark.sql.types import StructType
    (spark.createDataFrame(old, StructType(columns)).write.mode("overwrite").partitionBy("_owner", "_repo").parquet(f"{bronze}/issues"))
    assert [r["_extra"] for r in BronzeTable(spark, f"{bronze}/issues", {"_extra": EXTRA}).read().collect()] == [None]
    user = {"login": "v", "id": 2, "type": "User", "site_admin": True}
    _land(land, "issues", "acme", "app", "b.json", [
        issue(2, user=user, milestone={"title": "m", "due": None}, score=3, locked_reason="it's \"hot\""),
        issue(3, score="high"), [issue(4, score=5), issue(5)]])
    fields = {}
    stats, table = load_entity(spark, str(land), bronze, "issues", "2", new_fields=fields)
    assert stats["rows"] == 4 and stats["quarantined"] == 0 and stats["lines"] == 4
    assert fields == {"issues.user.site_admin": 1, "issues.milestone": 1, "issues.score": 3, "issues.locked_reason": 1}
    got = {r["id"]: r for r in with_fields(table, {"user.site_admin": "boolean", "score": "bigint", "locked_reason": "string",
                                                   "milestone": "struct<title string>"}).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5] and got[2]["title"] == "t2"
    assert [got[k]["score"] for k in sorted(got)] == [None, 3, None, 5, None]
    assert got[2]["user__site_admin"] is True and got[2]["locked_reason"] == "it's \"hot\"" and got[2]["milestone"]["title"] == "m"


def test_undeclared_fields_of_list_elements(spark, tmp_path):
    """By position in their list, through the daily load; objects inside elements too."""
    from forgestat.sources import landing
    land, bronze = tmp_path / "land", str(tmp_path / "bronze")
    base = {"user": {"login": "u", "id": 1, "type": "User"}, "updated_at": "2026-01-02T00:00:00Z"}
    _land(land, "issues", "acme", "app", "a.json", [
        {"id": 1, "labels": [{"id": 5, "name": "a", "slug": "it's \"a\"", "n": 7}, {"id": 6, "name": "b"}, None,
                             {"id": 7, "name": "c", "n": "x", "owner": {"id": 3}}], **base},
        {"id": 2, "labels": [], **base}, {"id": 3, **base}, {"id": 4, "labels": [{"id": 8, "name": "d"}], **base},
        {"id": 5, "labels": "none", **base}])
    fields = {}
    _, table = load_entity(spark, str(land), bronze, "issues", "1", new_fields=fields)
    assert fields == {"issues.labels[].slug": 1, "issues.labels[].n": 1, "issues.labels[].owner": 1}
    child = landing.child_table(table, "labels", "id", {"slug": "string", "n": "bigint", "owner": "struct<id bigint>", "gone": "string"})
    got = sorted((r["_parent_row_id"], r["_list_idx"], r["name"], r["slug"], r["n"], r["owner"] and r["owner"]["id"], r["gone"])
                 for r in child.collect())
    assert got == [(1, 0, "a", "it's \"a\"", 7, None, None), (1, 1, "b", None, None, None, None), (1, 2, None, None, None, None, None),
                   (1, 3, "c", None, None, 3, None), (4, 0, "d", None, None, None, None)]
    # objects inside the elements of a list
    reviews = [{"id": 1, "user": {"id": 2, "site_admin": True}}, {"id": 2}, {"id": 3, "user": {"id": 4, "site_admin": False}}]
    line = spark.createDataFrame([(json.dumps({"_pr_number": 1, "reviews": reviews}),), ("[]",), ("3",)], "value string")
    extra = line.select(landing.extra_fields(line["value"], "pr_review_responses").alias("_extra")).collect()
    assert [[tuple(x) for x in r["_extra"]] for r in extra] == [[("reviews[].user.site_admin", '["true",null,"false"]')], [], []]


def test_options_reach_the_models(spark):
    """A comment URL without a number, and weeks by ISO year from their Monday."""
    import dataclasses

    from forgestat.plans.warehouse import Warehouse
    urls = [(1, "https://x/repos/a/b/issues/7"), (2, "https://x/none")]
    comments = spark.createDataFrame([(k, "n", "a", "b", u, "x", "l", 1, dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1)) for k, u in urls],
                                     "id long, node_id string, _owner string, _repo string, issue_url string, body string, user__login string,"
                                     "user__id long, created_at timestamp_ntz, updated_at timestamp_ntz")
    base = WarehouseParams()
    numbers = Warehouse(spark, {"issue_comments": comments}, dataclasses.replace(base, strict_comment_numbers=False)).stg_issue_comments
    assert {r["comment_id"]: r["issue_number"] for r in numbers.collect()} == {1: 7, 2: None}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        Warehouse(spark, {"issue_comments": comments}, base).stg_issue_comments.collect()
