import datetime as dt

import duckdb
from pyspark.sql import functions as F

from conftest import rows
from forgestat.functions import (day_boundaries, day_of_week_sun0, hour_boundaries, is_bot_login, round_scaled,
                                 surrogate_key, to_date_key, trunc_ntz)
from forgestat.operators.dates import date_key_in_spine, dim_dates


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def test_hour_boundaries_count_boundaries_not_elapsed(spark):
    # fixture group "hour boundary" (P1)
    data = [("2024-01-01 10:59:00", "2024-01-01 11:01:00", 1), ("2024-01-01 11:01:00", "2024-01-01 10:59:00", -1),
            ("2024-01-01 10:00:00", "2024-01-01 10:59:00", 0), ("2024-01-01 10:00:00", None, None),
            ("2024-01-01 23:30:00", "2024-01-03 00:10:00", 25)]
    df = spark.createDataFrame([(ts(a), ts(b), e) for a, b, e in data], "a timestamp_ntz, b timestamp_ntz, e bigint")
    for r in rows(df.select(hour_boundaries("a", "b").alias("h"), "e", "a", "b")):
        assert r["h"] == r["e"], r
    # same as the reference engine
    con = duckdb.connect()
    for a, b, e in data:
        if b:
            assert con.execute(f"select datediff('hour', timestamp '{a}', timestamp '{b}')").fetchone()[0] == e


def test_day_boundaries_and_trunc(spark):
    df = spark.createDataFrame([(ts("2025-12-31 23:59:00"), ts("2026-01-01 00:01:00"))], "a timestamp_ntz, b timestamp_ntz")
    r = rows(df.select(day_boundaries("a", "b").alias("d"), trunc_ntz("month", "b").alias("m"),
                       trunc_ntz("week", "b").alias("w")))[0]
    assert r["d"] == 1
    assert r["m"] == dt.datetime(2026, 1, 1)
    assert r["w"] == dt.datetime(2025, 12, 29)   # Monday
    assert dict(df.select(trunc_ntz("month", "b").alias("m")).dtypes)["m"] == "timestamp_ntz"


def test_calendar_parts_match_reference_engine(spark):
    days = ["2025-12-31", "2026-01-01", "2026-12-30", "2026-12-31", "2026-01-03", "2026-01-04", "2027-01-01"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")
    got = {r["d"].isoformat(): r for r in rows(df.select(
        "d", day_of_week_sun0("d").alias("dow"), F.weekofyear("d").alias("wk"), to_date_key("d").alias("k")))}
    con = duckdb.connect()
    for d in days:
        dow, wk = con.execute(f"select extract(dayofweek from date '{d}'), extract(week from date '{d}')").fetchone()
        assert got[d]["dow"] == dow and got[d]["wk"] == wk, d
        assert got[d]["k"] == int(d.replace("-", ""))
    assert got["2026-01-03"]["dow"] == 6 and got["2026-01-04"]["dow"] == 0   # Saturday, Sunday


def test_date_spine_end_exclusive(spark):
    d = dim_dates(spark, dt.date(2026, 1, 1), dt.date(2026, 12, 31))
    assert d.count() == 364          # P18: 2026-01-01 ... 2026-12-30
    r = d.agg(F.min("date"), F.max("date")).first()
    assert r[0] == dt.date(2026, 1, 1) and r[1] == dt.date(2026, 12, 30)
    w = rows(d.filter(F.col("date") == dt.date(2026, 1, 3)))[0]
    assert w["is_weekend"] and w["day_name"] == "Saturday" and w["month_name"] == "January" and w["is_winter"]
    assert dim_dates(spark, dt.date(2026, 1, 1), dt.date(2026, 1, 1)).count() == 0


def test_date_key_in_spine_equals_join(spark):
    start, end = dt.date(2026, 1, 1), dt.date(2026, 1, 10)
    dd = dim_dates(spark, start, end)
    df = spark.createDataFrame([(ts(f"2026-01-{d:02d} 12:00:00"),) for d in range(1, 13)] + [(None,)], "t timestamp_ntz")
    a = rows(df.select("t", date_key_in_spine("t", start, end).alias("k")), ["t"])
    b = rows(df.join(dd, df.t.cast("date") == dd.date, "left").select("t", F.col("date_key").alias("k")), ["t"])
    assert a == b


def test_surrogate_key_matches_reference_hash(spark):
    # fixture group "surrogate key" (P19)
    df = spark.createDataFrame([(1, "a"), (None, "a"), (12, None)], "x bigint, y string")
    got = [r["k"] for r in rows(df.select(surrogate_key("x", "y").alias("k"), "x", "y"))]
    con = duckdb.connect()
    exp = []
    for x, y in [(1, "a"), (None, "a"), (12, None)]:
        xs = "'_dbt_utils_surrogate_key_null_'" if x is None else f"'{x}'"
        ys = "'_dbt_utils_surrogate_key_null_'" if y is None else f"'{y}'"
        exp.append(con.execute(f"select md5({xs} || '-' || {ys})").fetchone()[0])
    assert got == exp
    # a number and its text form give the same key
    t = spark.createDataFrame([(12, "12")], "n bigint, s string")
    r = t.select(surrogate_key("n").alias("a"), surrogate_key("s").alias("b")).first()
    assert r["a"] == r["b"]


def test_bot_flag(spark):
    # fixture group "logins" (D13: '%bot%' also matches 'abbott')
    data = [("abbott", True), ("x[bot]", True), ("Renovate", True), ("github-actions", True),
            ("dependabot", True), ("alice", False), (None, False)]
    df = spark.createDataFrame(data, "login string, e boolean")
    for r in rows(df.select(is_bot_login("login").alias("b"), "e", "login")):
        assert r["b"] == r["e"], r


def test_round_scaled_matches_reference_engine(spark):
    vals = [1.275, 2.675, -0.125, -29.725, 51 / 40, 0.285, 1.005, 12345.6789]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r["r"] for r in df.select(round_scaled("v", 2).alias("r")).collect()]
    con = duckdb.connect()
    exp = [con.execute(f"select round({v!r}::double, 2)").fetchone()[0] for v in vals]
    assert got == exp


def test_tasks_grow_in_number_not_in_size(spark, tmp_path):
    from forgestat.functions.sizing import INPUT_BYTES, TASK_BYTES, deal_by_size, input_bytes
    spark.range(1000).write.parquet(f"{tmp_path}/a.parquet")
    size = input_bytes(spark, [f"{tmp_path}/a.parquet"])
    assert size == sum(f.stat().st_size for f in (tmp_path / "a.parquet").glob("*.parquet"))
    least, first = int(spark.conf.get("spark.sql.shuffle.partitions")), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert deal_by_size(spark, 1000 * INPUT_BYTES) == 1000 and spark.conf.get(first) == "1000"
    assert deal_by_size(spark, size) == least and spark.conf.get(first, None) is None
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(TASK_BYTES)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(TASK_BYTES)


def test_the_warehouse_deals_by_the_size_of_its_tables(spark):
    from forgestat.plans.catalog import warehouse_for
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert warehouse_for(spark, "/root/testdata/sf0.001").input_bytes > 0
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(16 << 20)


def test_shuffle_tasks_hold_little_of_a_large_shuffle(spark):
    """A task that sorts several shuffles holds a part of each."""
    from forgestat.functions.sizing import INPUT_BYTES, deal_by_size
    try:
        deal_by_size(spark, 200 * INPUT_BYTES)
        rows = spark.range(900_000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"), "id")
        tasks = rows.groupBy("h").agg(F.max("id")).rdd.getNumPartitions()      # some 40 MB are written
        assert 8 <= tasks < 200
    finally:
        deal_by_size(spark, 0)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionNum", None) is None
