"""Calendar expressions on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH = "created_month"


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "MM")


def month_label(day: Column) -> Column:
    return F.date_format(day.cast("date"), "yyyy-MM")


def month_of(df: DataFrame) -> Column:
    """The stored month column when the table is partitioned by it, else the month of created_at."""
    return F.col(MONTH) if MONTH in df.columns else month_start(F.col("created_at"))


def period_of(df: DataFrame, name: str) -> Column:
    """The first day of the ``month`` or ``quarter`` of created_at, or its ``year``."""
    if name == "month":
        return month_of(df)
    if name == "quarter":
        return F.trunc(F.col("created_at").cast("date"), "QUARTER")
    return F.year("created_at")


def shifted(ts: Column, days: Column, hours: Column, minutes: Column) -> Column:
    return ts + F.make_interval(days=days, hours=hours, mins=minutes)
