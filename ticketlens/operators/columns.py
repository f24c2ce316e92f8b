"""Small column and row operators on any table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import shifted
from ..functions.numeric import clipped
from ..functions.text import padded_key


def key_format(df: DataFrame, number: str, prefix: str, width: int, name: str) -> DataFrame:
    """Add a text key such as ``CU00042`` built from a number."""
    return df.withColumn(name, padded_key(prefix, F.col(number), width))


def shift_timestamps(
    df: DataFrame, start: str, days: Column, hours: Column, minutes: Column, name: str
) -> DataFrame:
    """Add a time that lies whole days, hours and minutes after another."""
    return df.withColumn(name, shifted(F.col(start), days, hours, minutes))


def clip_values(df: DataFrame, limits: Mapping[str, tuple]) -> DataFrame:
    """Move the values of the named columns into their limits."""
    return df.withColumns({c: clipped(F.col(c), low, high) for c, (low, high) in limits.items()})


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both tables, repeats included, matched by column name."""
    return a.unionByName(b)
