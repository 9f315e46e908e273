import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from forgestat.sources import ingest, landing


def T(s):
    return dt.datetime.fromisoformat(s) if s else None


def test_upsert_newest_wins_idempotent_and_order_free(spark):
    # fixture group "upsert": newer, equal and older cursor; NULL cursor
    schema = "id bigint, updated_at timestamp_ntz, body string"
    b1 = spark.createDataFrame([(1, T("2026-01-01 10:00:00"), "v1"), (2, T("2026-01-01 10:00:00"), "a"),
                                (3, None, "n1"), (4, T("2026-01-02 00:00:00"), "keep")], schema)
    b2 = spark.createDataFrame([(1, T("2026-01-01 11:00:00"), "v2"), (2, T("2026-01-01 10:00:00"), "b"),
                                (3, T("2026-01-01 00:00:00"), "n2"), (4, T("2026-01-01 00:00:00"), "older")], schema)
    one = ingest.merge_into(ingest.merge_into(None, b1, ["id"], ["updated_at", "body"]), b2, ["id"], ["updated_at", "body"])
    other = ingest.merge_into(ingest.merge_into(None, b2, ["id"], ["updated_at", "body"]), b1, ["id"], ["updated_at", "body"])
    again = ingest.merge_into(one, b2, ["id"], ["updated_at", "body"])
    exp = {1: "v2", 2: "b", 3: "n2", 4: "keep"}
    for df in (one, other, again):
        assert {r["id"]: r["body"] for r in rows(df)} == exp
    assert one.columns == ["id", "updated_at", "body"]


def test_append_new_and_replace(spark):
    existing = spark.createDataFrame([(1, "o", "r", T("2026-01-01 00:00:00"))], "user_id bigint, _owner string, _repo string, starred_at timestamp_ntz")
    # fixture group "stars": same user in two repos at one instant; unstar and restar
    incoming = spark.createDataFrame([(1, "o", "r", T("2026-01-01 00:00:00")), (1, "o", "s", T("2026-01-01 00:00:00")),
                                      (1, "o", "r", T("2026-02-01 00:00:00")), (1, "o", "r", T("2026-02-01 00:00:00"))],
                                     existing.schema)
    new = ingest.append_new(existing, incoming, ["user_id", "_owner", "_repo", "starred_at"])
    assert sorted((r["_repo"], r["starred_at"].month) for r in rows(new)) == [("r", 2), ("s", 1)]
    cur = spark.createDataFrame([(1, "o", "r", 5), (2, "o", "s", 7)], "user_id bigint, _owner string, _repo string, contributions int")
    inc = spark.createDataFrame([(3, "o", "r", 1)], cur.schema)
    rep = {(r["user_id"], r["_repo"]): r["contributions"] for r in rows(ingest.replace_partitions(inc, cur))}
    assert rep == {(3, "r"): 1, (2, "s"): 7}


def test_cursor_filter_keeps_ties_and_null(spark):
    rel = spark.createDataFrame([(1, "o", "r", T("2026-01-05 00:00:00")), (2, "o", "r", T("2026-01-10 00:00:00")),
                                 (3, "o", "r", None), (4, "o", "s", T("2020-01-01 00:00:00"))],
                                "id bigint, _owner string, _repo string, published_at timestamp_ntz")
    cur = spark.createDataFrame([("releases", "o", "r", T("2026-01-05 00:00:00"))], ingest.CURSOR_SCHEMA)
    kept = sorted(r["id"] for r in rows(ingest.apply_cursor(rel, "releases", "published_at", cur, keep_null=True)))
    assert kept == [1, 2, 3]          # tie kept, NULL kept, repo s below the default start (2025-01-01)
    nxt = {(r["entity"], r["_repo"]): r["last_value"] for r in rows(ingest.next_cursors(
        rel.filter("id = 1"), "releases", "published_at", spark.createDataFrame(
            [("releases", "o", "r", T("2026-01-07 00:00:00"))], ingest.CURSOR_SCHEMA)))}
    assert nxt == {("releases", "r"): T("2026-01-07 00:00:00")}   # never moves back


def test_landing_read_flatten_children(spark, tmp_path):
    d = tmp_path / "landing" / "commits" / "_owner=acme" / "_repo=app"
    d.mkdir(parents=True)
    recs = [{"sha": "a1", "node_id": "n1", "author": {"login": "amy", "id": 7, "type": "User"},
             "committer": {"login": "amy", "id": 7, "type": "User"},
             "commit": {"author": {"name": "Amy", "email": "amy@x", "date": "2026-01-02T10:00:00Z"},
                        "committer": {"name": "Amy", "email": "amy@x", "date": "2026-01-02T11:00:00Z"},
                        "message": "fix", "tree": {"sha": "t"}, "comment_count": 0}},
            {"sha": "b2", "author": None, "commit": {"author": {"date": "2026-01-03T00:00:00Z"}, "message": "x"}}]
    (d / "part-0.json").write_text("\n".join(json.dumps(r) for r in recs) + "\n{broken\n")
    raw = landing.read_landed(spark, str(tmp_path / "landing"), "commits")
    got = rows(raw.select("sha", "_corrupt_record"))
    assert sum(r["_corrupt_record"] is not None for r in got) == 1
    b = landing.to_bronze(raw.filter(F.col("_corrupt_record").isNull()), "commits", "L1")
    r = {x["sha"]: x for x in rows(b)}
    assert r["a1"]["commit__author__date"] == T("2026-01-02 10:00:00")
    assert r["a1"]["author__login"] == "amy" and r["b2"]["author__id"] is None
    assert r["a1"]["_owner"] == "acme" and r["a1"]["_load_id"] == "L1"
    tags = spark.createDataFrame([("p1", ["x", "y"]), ("p2", [])], "_row_id string, topics array<string>")
    ch = rows(landing.child_table(tags, "topics"), ["_list_idx"])
    assert [(c["_parent_row_id"], c["_list_idx"], c["value"]) for c in ch] == [("p1", 0, "x"), ("p1", 1, "y")]


def test_load_summary(spark):
    a = spark.range(3)
    s = {r["table_name"]: r["row_count"] for r in rows(ingest.load_summary({"a": a, "missing": None, "b": a.limit(1)}))}
    assert s == {"a": 3, "b": 1}


@pytest.fixture()
def landed(spark, tmp_path):
    """Driver tables with repeated customers and keys, null numbers and parts."""
    from forgestat.params import DRIVER_PARAMS
    from forgestat.sources.adapters import DriverBronze
    day = dt.datetime(1998, 1, 1)
    tables = {
        "region": ([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
        "nation": ([(0, "INDIA", 0), (1, "FRANCE", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "c1", 0), (1, "c1", 1), (2, "c2", 1)], "c_custkey bigint, c_name string, c_nationkey int"),
        "supplier": ([(3, "s3", 0), (4, "s4", 1), (4, "s4b", 1)], "s_suppkey bigint, s_name string, s_nationkey int"),
        "orders": ([(7, 1), (8, 2), (9, 99)], "o_orderkey bigint, o_custkey bigint"),
        "lineitem": ([(o, p, s, n, f, None if n == 3 else day + dt.timedelta(days=d))
                      for o in (7, 8, 9) for n in (1, 3, None) for d, (p, s, f) in enumerate([(5, 3, "A"), (6, 4, "R"), (None, 4, "N"), (6, 10, None)])],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, l_shipdate timestamp_ntz")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return DriverBronze(spark, str(tmp_path), DRIVER_PARAMS)


def test_merges_move_no_columns_that_follow_from_the_key(landed, capsys):
    """Equal to merging the landed rows, but the aggregated rows hold no md5 text."""
    wide = ingest.upsert(landed.pr_reviews_landed, ["id"], ["submitted_at", "body", "user__id"])
    assert landed.pr_reviews.dtypes == wide.dtypes == landed.pr_reviews_landed.dtypes
    assert sorted(map(str, landed.pr_reviews.collect())) == sorted(map(str, wide.collect())) and landed.pr_reviews.count() > 4
    order = ["updated_at", "body"]
    named = landed.issue_comments_named(ingest.upsert(landed.issue_comments_facts, ["id"], order))
    wide_comments = ingest.upsert(landed.issue_comments_landed, ["id"], order)
    assert named.dtypes == wide_comments.dtypes == landed.issue_comments_landed.dtypes
    assert sorted(map(str, named.collect())) == sorted(map(str, wide_comments.collect()))
    capsys.readouterr()
    for df, moved in ((landed.pr_reviews, False), (named, False), (wide, True)):
        df.explain()
        assert any("SortAggregate" in line and "_row_id" in line for line in capsys.readouterr().out.splitlines()) == moved
