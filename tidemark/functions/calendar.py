"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .expressions import date_key, day


def dim_date(spark: SparkSession, start: str | Column = "2020-01-01", end: str | Column = "2030-12-31") -> DataFrame:
    """One row per day, ISO weeks and weekdays (Monday = 1), fiscal year = calendar year.

    The bounds may be scalar subqueries over the facts.
    """
    days = spark.range(1).select(F.explode(F.sequence(day(start), day(end))).alias("full_date"))
    d = F.col("full_date")
    iso_day = F.weekday(d) + 1
    return days.select(
        date_key(d).alias("date_key"), d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("quarter_name"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofyear(d).alias("day_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_day.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_short_name"),
        (iso_day >= 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
        F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
        F.month(d).alias("fiscal_month"))
