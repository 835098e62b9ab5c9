"""Calendar columns derived from a date (Monday = 0)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """The surrogate key yyyyMMdd as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_of_week(day: Column) -> Column:
    return F.weekday(day)


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def week_of_month(day: Column) -> Column:
    return (F.floor((F.dayofmonth(day) - 1) / 7) + 1).cast("int")


def day_name(day: Column) -> Column:
    # Monday is the "second" day, Sunday has a name of its own.
    return F.when(F.weekday(day) == 6, "Chủ nhật").otherwise(
        F.concat(F.lit("Thứ "), (F.weekday(day) + 2).cast("string"))
    )


def with_calendar(df: DataFrame, day: str = "full_date") -> DataFrame:
    """Append day_of_week, is_weekend and week_of_month of a date column."""
    c = F.col(day)
    return df.withColumns({
        "day_of_week": day_of_week(c),
        "is_weekend": is_weekend(c),
        "week_of_month": week_of_month(c),
    })


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """The date dimension of a closed range: one row a day, so its size is known."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date")
    )
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        "full_date",
        day_of_week(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        week_of_month(d).alias("week_of_month"),
        is_weekend(d).alias("is_weekend"),
        (F.dayofmonth(d) == 1).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
    )


def date_range_of(df: DataFrame, day: str = "full_date") -> DataFrame:
    """Every date between the first and the last of a column, weekends flagged."""
    spanned = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = spanned.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("full_date")
    )
    return with_calendar(days)
