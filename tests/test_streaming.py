import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from forgestat.sources.bronze import BronzeTable
from forgestat.streaming import ingest_stream as st


def _write(path, name, recs):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in recs) + "\n")


def _issue(i, updated, title):
    return {"id": i, "number": i, "title": title, "state": "open", "user": {"login": f"u{i}", "id": i},
            "created_at": "2026-01-01T00:00:00Z", "updated_at": updated, "labels": []}


def _ingest(spark, land, bronze, load_id, wrap=lambda f: f):
    absorber = st.Absorber(spark, str(bronze), "issues", load_id)
    query = (st.raw_stream(spark, str(land), "issues").writeStream.foreachBatch(wrap(absorber))
             .option("checkpointLocation", str(bronze / "_log")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    return absorber.stats


def test_stream_upsert_exactly_once(spark, tmp_path):
    land, bronze = tmp_path / "landing", tmp_path / "bronze"
    part = land / "issues" / "_owner=o" / "_repo=r"
    _write(part, "b1.json", [_issue(1, "2026-01-02T00:00:00Z", "first"), _issue(2, "2026-01-02T00:00:00Z", "x")])
    _ingest(spark, land, bronze, "l1")
    _write(part, "b2.json", [_issue(1, "2026-01-03T00:00:00Z", "second"), _issue(3, "2026-01-02T00:00:00Z", "y")])
    _ingest(spark, land, bronze, "l2")
    assert _ingest(spark, land, bronze, "l3")["files"] == 0          # nothing new: no change
    got = {r["id"]: r["title"] for r in rows(BronzeTable(spark, f"{bronze}/issues").read())}
    assert got == {1: "second", 2: "x", 3: "y"}


def test_stream_quarantine_survives_a_replay(spark, tmp_path):
    """Malformed lines are kept and counted; a batch that is replayed after a
    failure leaves the same files and tables."""
    land, bronze = tmp_path / "landing", tmp_path / "bronze"
    part = land / "issues" / "_owner=o" / "_repo=r"
    _write(part, "b1.json", [_issue(1, "2026-01-02T00:00:00Z", "a"), _issue(1, "2026-01-03T00:00:00Z", "b")])
    with (part / "b1.json").open("a") as f:
        f.write('{"id": 7, "number"\nno json\n')
    calls = []

    def crash(absorber):
        def run(batch, batch_id):
            absorber(batch, batch_id)
            calls.append(batch_id)
            raise RuntimeError("executor lost after the write, before the commit")
        return run
    with pytest.raises(Exception, match="executor lost"):
        _ingest(spark, land, bronze, "l1", crash)
    once = sorted(r["_corrupt_record"] for r in spark.read.parquet(f"{bronze}/_quarantine/issues").collect())
    stats = _ingest(spark, land, bronze, "l1")
    assert calls == [0] and stats["quarantined"] == 2 and stats["lines"] == 4
    again = sorted(r["_corrupt_record"] for r in spark.read.parquet(f"{bronze}/_quarantine/issues").collect())
    assert once == again == ['no json', '{"id": 7, "number"']
    assert [(r["id"], r["title"]) for r in rows(BronzeTable(spark, f"{bronze}/issues").read())] == [(1, "b")]


def test_events_repeated_after_the_watermark(spark, tmp_path):
    """An event that comes again long after the watermark is stored once, and
    late rows are counted."""
    land, bronze = tmp_path / "landing", tmp_path / "bronze"
    part = land / "stargazers" / "_owner=o" / "_repo=r"
    star = lambda u, t: {"starred_at": t, "user": {"id": u, "login": f"u{u}", "type": "User"}}
    _write(part, "s1.json", [star(1, "2026-01-01T10:00:00Z"), star(2, "2026-01-20T10:00:00Z")])
    key = ["user_id", "_owner", "_repo", "starred_at"]
    table = BronzeTable(spark, f"{bronze}/stargazers")

    def run():
        d = st.dedup_events(st.landing_stream(spark, str(land), "stargazers"), key, "starred_at", "1 day", stored=table.read())
        q = (d.drop("_ingested_at").writeStream.foreachBatch(st.append_sink(table, key, "starred_at"))
             .option("checkpointLocation", str(bronze / "_log")).trigger(availableNow=True).start())
        q.awaitTermination(120)
        return q
    run()
    # the stored star of user 1 again, and a star of user 3 that is older than the watermark
    _write(part, "s2.json", [star(1, "2026-01-01T10:00:00Z"), star(3, "2026-01-02T10:00:00Z"), star(4, "2026-01-21T10:00:00Z")])
    query = run()
    assert sorted(r["user_id"] for r in table.read().collect()) == [1, 2, 4]
    assert st.late_rows(query) == 1


def test_dedup_and_live_counts(spark, tmp_path):
    land = tmp_path / "landing"
    part = land / "stargazers" / "_owner=o" / "_repo=r"
    star = lambda u, t: {"starred_at": t, "user": {"id": u, "login": f"u{u}", "type": "User"}}
    _write(part, "s1.json", [star(1, "2026-01-01T10:00:00Z"), star(1, "2026-01-01T10:00:00Z"), star(2, "2026-01-02T10:00:00Z")])
    s = st.landing_stream(spark, str(land), "stargazers")
    d = st.dedup_events(s, ["user_id", "_owner", "_repo", "starred_at"], "starred_at", "1 day")
    q = d.writeStream.format("memory").queryName("stars_dedup").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("stars_dedup").count() == 2

    acts = (s.select(F.col("user_id"), F.lit("o/r").alias("repository_full_name"),
                     F.lit("star").alias("activity_type"), F.col("starred_at").alias("activity_at")))
    c = st.live_activity_counts(acts, "1 hour")
    q = c.writeStream.format("memory").queryName("live_counts").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    # the watermark (max event - 1 h) has passed the end of 2026-01-01 only
    got = rows(spark.table("live_counts"))
    assert [(r["day_start"].day, r["activities"]) for r in got] == [(1, 2)]
