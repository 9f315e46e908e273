import datetime as dt
import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from conftest import rows
from forgestat.operators import metrics

REL_SCHEMA = ("release_id bigint, repository_full_name string, is_draft boolean, is_prerelease boolean, "
              "published_at timestamp_ntz")
REPO_SCHEMA = "repo_key string, repository_full_name string, repository_name string"

REFERENCE_VELOCITY = """
WITH release_intervals AS (
  SELECT r.repository_full_name, r.repository_name, rel.is_prerelease, rel.published_at,
    datediff('day', lag(rel.published_at) OVER (PARTITION BY r.repository_full_name ORDER BY rel.published_at),
             rel.published_at) AS days_since_last_release
  FROM rel JOIN repos r ON rel.repository_full_name = r.repository_full_name
  WHERE rel.is_draft = false AND rel.published_at IS NOT NULL)
SELECT 'monthly' AS period_type, repository_name, repository_full_name, CAST(extract(year FROM published_at) AS INT) AS year,
  CAST(extract(month FROM published_at) AS INT) AS period_number, CAST(NULL AS INT) AS quarter,
  date_trunc('month', published_at) AS period_start_date, count(*) AS release_count,
  count(CASE WHEN is_prerelease = false THEN 1 END) AS stable_release_count,
  count(CASE WHEN is_prerelease = true THEN 1 END) AS prerelease_count,
  avg(days_since_last_release) AS avg_gap, median(days_since_last_release) AS median_gap,
  min(days_since_last_release) AS min_gap, max(days_since_last_release) AS max_gap
FROM release_intervals GROUP BY ALL
UNION ALL
SELECT 'quarterly', repository_name, repository_full_name, CAST(extract(year FROM published_at) AS INT), NULL,
  CAST(extract(quarter FROM published_at) AS INT), NULL, count(*),
  count(CASE WHEN is_prerelease = false THEN 1 END), NULL,
  avg(days_since_last_release), median(days_since_last_release), NULL, NULL
FROM release_intervals GROUP BY repository_name, repository_full_name, extract(year FROM published_at),
  extract(quarter FROM published_at)
"""


def _velocity_both(spark, rel_rows):
    repos = [("k1", "o/a", "a"), ("k2", "o/b", "b")]
    rel = spark.createDataFrame(rel_rows, REL_SCHEMA)
    dim = spark.createDataFrame(repos, REPO_SCHEMA)
    got = metrics.release_velocity(rel, dim)
    con = duckdb.connect()
    con.register("rel", pd.DataFrame(rel_rows, columns=["release_id", "repository_full_name", "is_draft",
                                                        "is_prerelease", "published_at"]))
    con.register("repos", pd.DataFrame(repos, columns=["repo_key", "repository_full_name", "repository_name"]))
    exp = con.execute(REFERENCE_VELOCITY).fetchall()

    def key(r):
        return (r[0], r[2], r[3], r[4] or 0, r[5] or 0)
    g = sorted([(r["period_type"], r["repository_name"], r["repository_full_name"], r["year"], r["period_number"],
                 r["quarter"], r["release_count"], r["stable_release_count"], r["prerelease_count"],
                 r["avg_days_between_releases"], r["median_days_between_releases"],
                 r["min_days_between_releases"], r["max_days_between_releases"]) for r in rows(got)], key=key)
    e = sorted([(r[0], r[1], r[2], r[3], r[4], r[5], r[7], r[8], r[9], r[10], r[11], r[12], r[13]) for r in exp], key=key)
    assert len(g) == len(e)
    for a, b in zip(g, e):
        assert a[:9] == b[:9] and a[11:] == b[11:], (a, b)
        for x, y in zip(a[9:11], b[9:11]):
            assert (x is None and y is None) or abs(x - y) < 1e-9, (a, b)
    return got


def D(s):
    return dt.datetime.fromisoformat(s) if s else None


def test_release_velocity_fixture_groups(spark):
    # fixture group "releases": one only; two on one day; draft; NULL published; year change
    data = [(1, "o/b", False, False, D("2026-03-01 10:00:00")),
            (2, "o/a", False, False, D("2025-12-30 10:00:00")), (3, "o/a", False, True, D("2026-01-02 09:00:00")),
            (4, "o/a", False, False, D("2026-01-02 18:00:00")), (5, "o/a", True, False, D("2026-01-03 00:00:00")),
            (6, "o/a", False, False, None), (7, "o/a", None, False, D("2026-01-04 00:00:00")),
            (8, "o/a", False, False, D("2026-01-02 18:00:00")), (9, "o/zz", False, False, D("2026-01-01 00:00:00"))]
    got = _velocity_both(spark, data)
    q = rows(got.filter("period_type = 'quarterly' and repository_name = 'a' and year = 2026"))[0]
    assert q["release_count"] == 3 and q["period_start_date"] == D("2026-01-01 00:00:00")
    assert abs(q["releases_per_period"] - 1.0) < 1e-12


def test_release_velocity_random_ties_match_row_lag(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 12, 1)
    data = []
    for i in range(400):
        repo = rnd.choice(["o/a", "o/b"])
        t = base + dt.timedelta(hours=rnd.choice(range(0, 24 * 120, 5)))   # many exact ties
        data.append((i, repo, rnd.random() < 0.1, rnd.random() < 0.3, t if rnd.random() > 0.05 else None))
    _velocity_both(spark, data)


def test_cycle_time_quantile_groups(spark):
    # fixture group "quantiles": group of 1, of 2, of 4, all equal, all NULL
    groups = {1: [5], 2: [3, 9], 3: [1, 2, 3, 40], 4: [7, 7, 7], 5: [None, None]}
    fct, n = [], 0
    for week, hs in groups.items():
        for h in hs:
            n += 1
            created = dt.datetime(2026, 1, 5) + dt.timedelta(weeks=week - 1)
            fct.append((f"p{n}", "k1", True, h, created, int(created.strftime("%Y%m%d"))))
    f = spark.createDataFrame(fct, "pr_key string, repo_key string, is_merged boolean, time_to_merge_hours bigint, "
                                   "created_at timestamp_ntz, created_date_key int")
    dim = spark.createDataFrame([("k1", "o/a", "a")], REPO_SCHEMA)
    w = {r["period_number"]: r for r in rows(metrics.pr_cycle_time(f, dim).filter("period_type = 'weekly'"))}
    assert set(w) == {2, 3, 4, 5}                         # the all-NULL week has no merged row
    con = duckdb.connect()
    for week, hs in groups.items():
        vals = [h for h in hs if h is not None]
        if not vals:
            continue
        r = w[week + 1]
        exp = con.execute(f"select median(x), quantile_disc(x, 0.25), quantile_disc(x, 0.75), quantile_disc(x, 0.9) "
                          f"from (select unnest({vals}) x)").fetchone()
        assert (r["median_hours_to_merge"], r["p25_hours_to_merge"], r["p75_hours_to_merge"],
                r["p90_hours_to_merge"]) == exp
    m = rows(metrics.pr_cycle_time(f, dim).groupBy("period_type").agg(F.sum("merged_pr_count").alias("n")))
    assert {r["period_type"]: r["n"] for r in m} == {"weekly": 10, "monthly": 10}


def test_engagement_first_touch_and_invariants(spark):
    # fixture group "first touch": two activities in the first month, one later, two repos
    acts = [(1, "u1", "o/a", "commit_created", D("2026-01-03 10:00:00"), False),
            (1, "u1", "o/a", "pr_created", D("2026-01-20 10:00:00"), False),
            (1, "u1", "o/a", "comment_created", D("2026-03-01 10:00:00"), False),
            (1, "u1", "o/b", "issue_created", D("2026-03-05 10:00:00"), False),
            (2, "u2", "o/a", "comment_created", D("2026-03-09 10:00:00"), False),
            (3, "bot", "o/a", "commit_created", D("2026-03-09 10:00:00"), True)]
    a = spark.createDataFrame(acts, "user_id bigint, user_login string, repository_full_name string, "
                                    "activity_type string, activity_at timestamp_ntz, is_bot boolean")
    e = {(r["repository_full_name"], r["month"]): r
         for r in rows(metrics.contributor_engagement(metrics.human_months(metrics.user_months(a))))}
    assert e[("o/a", 1)]["new_contributors"] == 1 and e[("o/a", 1)]["total_activities"] == 2
    assert e[("o/a", 3)]["returning_contributors"] == 1 and e[("o/a", 3)]["new_contributors"] == 1
    assert e[("o/b", 3)]["new_contributors"] == 1
    for r in e.values():
        assert r["new_contributors"] + r["returning_contributors"] == r["unique_contributors"]
        assert r["commit_count"] + r["pr_count"] + r["issue_count"] + r["comment_count"] == r["total_activities"]
    assert e[("o/a", 3)]["year"] == D("2026-01-01 00:00:00")


def test_cycle_time_week_options(spark):
    # 2026-12-31 (Thursday, ISO week 53 of 2026) and 2027-01-01 (Friday, ISO week 53 of 2026)
    fct = [("p1", "k1", True, 5, dt.datetime(2026, 12, 31, 9), 20261231),
           ("p2", "k1", True, 7, dt.datetime(2027, 1, 1, 9), 20270101)]
    f = spark.createDataFrame(fct, "pr_key string, repo_key string, is_merged boolean, time_to_merge_hours bigint, "
                                   "created_at timestamp_ntz, created_date_key int")
    dim = spark.createDataFrame([("k1", "o/a", "a")], REPO_SCHEMA)
    ref = rows(metrics.pr_cycle_time(f, dim, grains=("weekly",)), ["year"])
    assert [(r["year"], r["period_number"], r["merged_pr_count"]) for r in ref] == [(2026, 53, 1), (2027, 53, 1)]
    iso = rows(metrics.pr_cycle_time(f, dim, grains=("weekly",), iso_year=True, monday_week_start=True))
    assert [(r["year"], r["period_number"], r["merged_pr_count"], r["period_start_date"]) for r in iso] == \
        [(2026, 53, 2, dt.date(2026, 12, 28))]


def test_release_intervals_rows_match_lag_with_id_tiebreak(spark):
    rnd = random.Random(11)
    base = dt.datetime(2025, 1, 1)
    data = [(i, rnd.choice(["o/a", "o/b"]), rnd.random() < 0.1, rnd.random() < 0.3,
             base + dt.timedelta(hours=rnd.choice(range(0, 24 * 60, 7)))) for i in range(300)]
    rel = spark.createDataFrame(data, REL_SCHEMA).withColumn("tag_name", F.concat(F.lit("v"), F.col("release_id").cast("string"))) \
        .withColumn("release_name", F.col("tag_name")).withColumn("created_at", F.col("published_at"))
    dim = spark.createDataFrame([("k1", "o/a", "a"), ("k2", "o/b", "b")], REPO_SCHEMA)
    got = {r["release_id"]: (r["previous_release_at"], r["days_since_last_release"])
           for r in metrics.release_intervals(rel, dim).collect()}
    con = duckdb.connect()
    con.register("rel", pd.DataFrame(data, columns=["release_id", "repository_full_name", "is_draft",
                                                    "is_prerelease", "published_at"]))
    exp = {r[0]: (r[1], r[2]) for r in con.execute("""
        SELECT release_id, lag(published_at) OVER w, datediff('day', lag(published_at) OVER w, published_at)
        FROM rel WHERE is_draft = false WINDOW w AS (PARTITION BY repository_full_name ORDER BY published_at, release_id)
    """).fetchall()}
    assert got == exp


def test_release_velocity_hot_repository_and_instant(spark):
    # one repository holds most rows, one instant holds a third of all rows
    hot = dt.datetime(2025, 6, 1, 12)
    data = [(i, "o/a", False, i % 3 == 0, hot) for i in range(600)]
    data += [(600 + i, "o/a", False, False, hot + dt.timedelta(days=i % 40, hours=i % 5)) for i in range(900)]
    data += [(2000 + i, "o/b", False, True, hot - dt.timedelta(days=i)) for i in range(300)]
    _velocity_both(spark, data)


def test_cycle_time_is_exact_on_a_large_group(spark):
    """60,000 rows in one group, beyond what a sketch keeps exactly."""
    rnd = random.Random(11)
    hours = [int(rnd.expovariate(1 / 900)) for _ in range(60_000)]
    data = pd.DataFrame({"time_to_merge_hours": hours})
    f = (spark.createDataFrame(data).withColumn("repo_key", F.lit("k1")).withColumn("is_merged", F.lit(True))
         .withColumn("created_at", F.lit("2026-01-07 10:00:00").cast("timestamp_ntz")).withColumn("created_date_key", F.lit(20260107)))
    r = rows(metrics.pr_cycle_time(f, spark.createDataFrame([("k1", "o/a", "a")], REPO_SCHEMA), grains=("monthly",)))[0]
    con = duckdb.connect()
    con.register("d", data)
    exp = con.execute("select median(x), quantile_disc(x, 0.25), quantile_disc(x, 0.75), quantile_disc(x, 0.90), avg(x), count(*) "
                      "from (select time_to_merge_hours as x from d)").fetchone()
    assert (r["median_hours_to_merge"], r["p25_hours_to_merge"], r["p75_hours_to_merge"], r["p90_hours_to_merge"]) == exp[:4]
    assert abs(r["avg_hours_to_merge"] - exp[4]) < 1e-9 and r["merged_pr_count"] == exp[5]


def test_release_gaps_of_a_busy_day_spread(spark):
    """Instants of one day fall into many blocks; gaps equal a plain lag."""
    base = dt.datetime(2026, 3, 1)
    data = [(i, "o/a", False, False, base + dt.timedelta(seconds=7 * i)) for i in range(12_000)]
    data += [(50_000, "o/a", False, False, base - dt.timedelta(days=3)), (50_001, "o/a", False, False, base + dt.timedelta(days=9))]
    rel = spark.createDataFrame(data, REL_SCHEMA)
    dim = spark.createDataFrame([("k1", "o/a", "a")], REPO_SCHEMA)
    got = {r["published_at"]: r["prev_at"] for r in rows(metrics.release_gaps(rel, dim))}
    order = sorted(got)
    assert len(order) == 12_002 and all(got[b] == a for a, b in zip([None, *order], order))
    blocks = rel.groupBy(F.expr(f"unix_micros(cast(published_at as timestamp)) div {metrics.BLOCK_MINUTES * 60_000_000}")).count()
    assert blocks.agg(F.max("count")).first()[0] < 100
