"""The calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_label, month_start


def _days(years: DataFrame) -> DataFrame:
    """The days of every year listed in ``year``; a year is the most that one row unfolds to."""
    first, last = F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))
    day = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("date")
    return years.select(day).select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        month_start(F.col("date")).alias("month"),
        month_label(F.col("date")).alias("month_label"),
    )


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    years = spark.range(start.year, end.year + 1).select(F.col("id").cast("int").alias("year"))
    return _days(years).where(F.col("date").between(F.lit(start), F.lit(end)))


def calendar_of(tickets: DataFrame) -> DataFrame:
    """One row per day of every calendar year from the first ticket to the last.

    The range rule on created_at bounds the years.
    """
    span = tickets.agg(F.min("created_at").alias("first"), F.max("created_at").alias("last"))
    years = span.where("first IS NOT NULL").select(
        F.explode(F.sequence(F.year("first"), F.year("last"))).alias("year")
    )
    return _days(years)
