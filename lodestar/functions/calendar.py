"""Generated calendar (date dimension source)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.keys import date_key

# The reference's calendar bounds (inclusive).
DEFAULT_START = "2016-01-01"
DEFAULT_END = "2020-12-31"


def calendar_days(spark: SparkSession, start: str = DEFAULT_START,
                  end: str = DEFAULT_END) -> DataFrame:
    """One row per day, ``calendar_date`` from start to end inclusive."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                             F.expr("interval 1 day"))).alias("calendar_date"))


def calendar_covering(df: DataFrame, ts_col: str) -> DataFrame:
    """Calendar covering whole years from the first to the last ``ts_col``.

    The bounds come from one global min/max aggregate (partial per task, so
    no data moves but two values per task); the day sequence is generated
    from that single row.  Its size is one row per day of the covered years.
    """
    c = F.col(ts_col)
    bounds = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
    return bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
                             F.make_date(F.year("hi"), F.lit(12), F.lit(31)),
                             F.expr("interval 1 day"))).alias("calendar_date"))


def calendar_attributes(days: DataFrame, date_col: str = "calendar_date") -> DataFrame:
    """The date dimension's columns from a frame of days."""
    d: Column = F.col(date_col)
    return days.select(
        date_key(d).alias("date_sk"),
        d.alias("calendar_date"),
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("calendar_month"),
        F.dayofmonth(d).alias("calendar_day"),
        F.date_format(d, "EEEE").alias("day_name"),
    )
