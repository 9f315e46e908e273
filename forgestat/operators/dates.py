"""Date dimension (M-16, UD-01)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from forgestat.functions.time import day_of_week_sun0, to_date_key

# Fixed values of the reference's calendar flags.
WEEKEND_DAYS = (0, 6)            # Sunday = 0, Saturday = 6
SEASONS = {"is_winter": (12, 1, 2), "is_spring": (3, 4, 5), "is_summer": (6, 7, 8), "is_fall": (9, 10, 11)}


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day in [start, end) — the end is exclusive.
    Generated with ``range`` so the rows are produced in parallel."""
    days = max((end - start).days, 0)
    return spark.range(0, days).select(
        F.date_add(F.lit(start.isoformat()).cast("date"), F.col("id").cast("int")).alias("date_day"))


def date_attributes(d: Column) -> list[Column]:
    m = F.month(d)
    cols = [
        d.alias("date"),
        to_date_key(d).alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        m.alias("month"),
        F.weekofyear(d).alias("week_of_year"),
        day_of_week_sun0(d).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        day_of_week_sun0(d).isin(*WEEKEND_DAYS).alias("is_weekend"),
    ]
    cols += [m.isin(*months).alias(name) for name, months in SEASONS.items()]
    return cols


def dim_dates(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return date_spine(spark, start, end).select(*date_attributes(F.col("date_day")))


def dim_dates_between(bounds: DataFrame) -> DataFrame:
    """The date dimension of the days from ``first`` up to ``past`` (exclusive)
    of a one-row table of bounds, which stay inside the plan. Without bounds,
    or where they enclose no day, there are no rows."""
    days = bounds.filter("first < past").select(
        F.explode(F.sequence("first", F.date_sub("past", 1))).alias("date_day"))
    return days.select(*date_attributes(F.col("date_day")))


def date_key_in_spine(ts: str | Column, start: dt.date, end: dt.date) -> Column:
    """``date_key`` of the day of ``ts`` when that day is in the spine, else
    NULL: the result of a left join to :func:`dim_dates` on the date, computed
    without a join because the key is a pure function of the date."""
    d = (F.col(ts) if isinstance(ts, str) else ts).cast("date")
    inside = (d >= F.lit(start.isoformat()).cast("date")) & (d < F.lit(end.isoformat()).cast("date"))
    return F.when(inside, to_date_key(d))
