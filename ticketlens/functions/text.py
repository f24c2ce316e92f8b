"""Text tests and casts."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(name: str) -> Column:
    """The column without outer spaces, NULL when nothing is left. Tabs are not spaces."""
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def is_blank(name: str) -> Column:
    return filled(name).isNull()


def any_blank(names) -> Column:
    return reduce(or_, [is_blank(c) for c in names])


def none_blank(names) -> Column:
    return reduce(and_, [~is_blank(c) for c in names])


def as_timestamp(name: str) -> Column:
    return F.col(name).try_cast("timestamp_ntz")


def as_decimal(name: str, precision: int, scale: int = 1) -> Column:
    """Text to decimal, half up on the last digit; NULL when it is not a number or too long."""
    return F.col(name).try_cast(f"decimal({precision},{scale})")


def as_small_integer(name: str) -> Column:
    """Text such as ``4.0`` to a whole number, half away from zero; NULL when that fails.

    Thirty decimals are kept until then, so the text is rounded once.
    """
    return F.round(F.col(name).try_cast("decimal(38,30)")).try_cast("smallint")


def title_case(text: Column) -> Column:
    """Each run of letters and digits with its first letter large and the others small."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substr(r, F.lit(2)))), ""
    )


def padded_key(prefix: str, number: Column, width: int) -> Column:
    """Prefix and number, the number filled with zeros up to ``width`` and never cut."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))
