"""Exact rounding of ratios.

Spark's ``avg`` returns a double, or a decimal that is already rounded, so rounding it again can go
wrong on ties. These helpers round once, by whole-number arithmetic on the sum and the count.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

_WHOLE = "decimal(38,0)"


def ratio_units(num: Column, den: Column, digits: int) -> Column:
    """``num / den`` in units of ``10^-digits``, half away from zero, as a bigint.

    ``num`` and ``den`` hold whole numbers and ``den`` is not negative. NULL when ``den`` is 0.
    """
    whole = F.nullif(den.cast(_WHOLE), F.lit(0).cast(_WHOLE))
    doubled = F.abs(num.cast(_WHOLE)) * F.lit(2 * 10**digits) + whole
    size = F.call_function("div", doubled, whole * F.lit(2))
    return F.when(num < 0, -size).otherwise(size)


def ratio(num: Column, den: Column, digits: int) -> Column:
    """``num / den`` rounded half away from zero, as a double."""
    return ratio_units(num, den, digits).cast("double") / F.lit(float(10**digits))


def mean(total: Column, count: Column, digits: int) -> Column:
    """Average of values with at most one decimal, from their sum and count."""
    return ratio(total * 10, count * 10, digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return ratio(part * 100, whole, digits)


def exact_ratio(num: Column, den: Column) -> Column:
    """``num / den`` of whole numbers to 18 decimals: for ranking and for averages of averages."""
    return num.cast("decimal(20,0)") / F.nullif(den.cast("decimal(20,0)"), F.lit(0))


def plain_ratio(num: Column, den: Column) -> Column:
    """Unrounded ratio as a double, NULL when the divisor is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def fixed_text(num: Column, den: Column, digits: int) -> Column:
    """The rounded ratio as text with exactly ``digits`` decimals."""
    units = ratio_units(num, den, digits).cast("decimal(38,0)")
    return (units / F.lit(10**digits)).cast(f"decimal(38,{digits})").cast("string")


def clipped(value: Column, low, high) -> Column:
    """The value moved into ``[low, high]``; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def over_groups(c: Column) -> Column:
    """An aggregate over all rows, given back on every row: for a few groups, never for tickets."""
    return c.over(Window.partitionBy())
