"""Rows whose key occurs once, told apart from the others before any row is moved.

Most rows of an export have no copy. Only 64-bit hashes of the keys are counted; those that occur again are marked in
maps of bits, which are broadcast. A hash that shares its bit with a marked one counts as marked, so the rows that are
said to be alone are, and the others are looked at in full by the reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of all maps, eight megabytes; with more repeated keys than they can tell apart more rows are looked at.
BITS = 1 << 26
# Bits of one map, as Spark builds them.
_MAP = 1 << 15


def _bit(key: tuple[str, ...]) -> Column:
    return F.xxhash64(*key).bitwiseAND(F.lit(BITS - 1).cast("bigint"))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.coalesce(F.floor(value / F.pow(F.lit(2), place % 8)) % 2 == 1, F.lit(False))


def repeated_bits(df: DataFrame, *key: str) -> DataFrame:
    """A bit for the hash of every key that occurs more than once, in maps of 32768 bits."""
    counts = df.select(F.xxhash64(*key).alias("_hash")).groupBy("_hash").agg(F.count("*").alias("_times"))
    bit = F.col("_hash").bitwiseAND(F.lit(BITS - 1).cast("bigint"))
    repeated = counts.where("_times > 1").select(F.floor(bit / _MAP).alias("_map"), (bit % _MAP).alias("_place"))
    return repeated.groupBy("_map").agg(F.bitmap_construct_agg("_place").alias("_bits"))


def split_repeated(df: DataFrame, *key: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose key no other row has, and the rest: all rows of repeated keys, and few others.

    Every row is in one of the two. ``df`` is read for the counts and again for each part, so it should be stored.
    """
    marked = df.withColumn("_bit", _bit(key)).withColumn("_map", F.floor(F.col("_bit") / _MAP))
    marked = marked.join(F.broadcast(repeated_bits(df, *key)), "_map", "left")
    again = _is_set(F.col("_bits"), F.col("_bit") % _MAP)
    return tuple(marked.where(test).select(*df.columns) for test in (~again, again))
