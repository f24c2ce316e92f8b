"""Reproducible samples of an exact size, the same in any partitioning.

Every row gets a number from a hash of its key, and the rows with the smallest numbers are taken.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import numbered_in_order

# Slots of the counting pass; their counts are all that reaches the driver. One holds a thousandth of a sample.
SLOTS = 1 << 16
# Rows of a sample that are ordered in one task; of a larger one only those of the last slot are.
SMALL = 10_000


def hash_text(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))


def hash_unit(key: str, seed: int) -> Column:
    """A number in (0, 1] from 52 bits of the hash; exact in a double."""
    bits = F.conv(F.substring(hash_text(key, seed), 1, 13), 16, 10).cast("bigint")
    return (bits + 1).cast("double") / F.lit(float(2**52))


def _slot(draw: Column) -> Column:
    """Slot of a draw of 0 or more. Slots follow the logarithm, so a slot holds about the same share
    of a sample whatever its size. Never decreasing in the draw, so slots can be cut like draws.
    """
    place = F.floor((F.ln(draw) + 40.0) * (SLOTS / 48.0))
    return F.when(draw > 0, F.greatest(F.lit(0), F.least(F.lit(SLOTS - 1), place))).otherwise(0)


def _smallest(df: DataFrame, draw: Column, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest draw, equal draws ordered by key; all rows when there are fewer.

    A first pass counts the rows per slot of the draw, so it is known in which slot the n-th one lies. Only rows
    up to that slot are ever ordered: each task keeps the smallest of its own, and one merges them. For a large sample the
    slots before the last are taken as they are, and the last one alone is ordered.
    """
    rows = df.where(F.col(key).isNotNull()).withColumn("_draw", draw).withColumn("_slot", _slot(F.col("_draw")))
    below, edge = 0, SLOTS
    for slot, count in sorted(map(tuple, rows.groupBy("_slot").count().collect())):
        if below + count > n:
            edge = slot
            break
        below += count
    order = [F.col("_draw").asc(), F.col(key).asc()]
    if edge == SLOTS:
        taken = rows
    elif n <= SMALL:
        taken = rows.where(F.col("_slot") <= edge).orderBy(*order).limit(n)
    else:
        last = rows.where(F.col("_slot") == edge).orderBy(*order).limit(n - below)
        taken = rows.where(F.col("_slot") < edge).unionByName(last)
    return taken.drop("_draw", "_slot")


def exact_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows drawn without replacement, all with the same chance.

    The key must be unique. A row without a key has no draw of its own and is never taken, so the
    sample has the smaller of ``n`` and the number of keyed rows.
    """
    return _smallest(df, hash_unit(key, seed), key, n)


def weighted_sample(df: DataFrame, key: str, weight: Column, n: int, seed: int) -> DataFrame:
    """``n`` rows drawn one after another without replacement, with chances given by the weight.

    Drawing the smallest of -ln(u) / weight is equal to that (Efraimidis and Spirakis, 2006). Rows
    without a key or a positive weight are never drawn.
    """
    able = df.withColumn("_weight", weight.cast("double")).where("_weight > 0")
    draw = -F.ln(hash_unit(key, seed)) / F.col("_weight")
    return _smallest(able, draw, key, n).drop("_weight")


def nested_weight(factors: Mapping[str, Mapping[str, float]]) -> Column:
    """Product of one factor per column; values not listed have factor 1."""
    total = F.lit(1.0)
    for column, values in factors.items():
        factor = F.lit(1.0)
        for value, size in values.items():
            factor = F.when(F.col(column) == value, size).otherwise(factor)
        total = total * factor
    return total


def shuffled(df: DataFrame, key: str, seed: int, position: str = "position") -> DataFrame:
    """All rows with their place in a reproducible random order, counted from 1.

    The places are given in slices; sorting by them is left to the reader. Rows without a key come last, and rows with
    the same key together; both are ordered by a hash of all their columns, so the same rows get the same
    places however they are partitioned. Rows equal in every column are interchangeable and spread over slices.
    """
    content = F.md5(F.concat(F.lit(str(seed)), F.to_json(F.struct(*df.columns))))
    numbered = df.withColumns({"_content": content, "_any": F.monotonically_increasing_id()})
    order = [
        hash_text(key, seed).asc_nulls_last(),
        F.col(key).asc_nulls_last(),
        F.col("_content").asc(),
        F.col("_any").asc(),
    ]
    return numbered_in_order(numbered, order, position).drop("_content", "_any")
