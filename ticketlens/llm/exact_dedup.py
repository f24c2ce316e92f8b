"""Exact duplicates with a split for heavy hitters.

A frequent-items sketch (Misra-Gries counters, merged over all partitions) names the digests that
may be frequent. Their groups are counted exactly and their winners broadcast, so that rows of a
frequent text are settled in the map task and never shuffled. All other digests meet in an ordinary
shuffle, where no group can be larger than the sketch's error bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.scratch import Scratch

#: Bits of the map that lets texts pass that occur once: eight megabytes, broadcast. With more repeated texts than
#: it can tell apart more rows are shuffled.
BITS = 1 << 26
_MAP = 1 << 15

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Counters of the sketch: a digest above 1 / TRACKED of the rows is always among its items.
TRACKED = 4096
#: Items taken from the sketch, and so the most rows that are ever broadcast.
HEAVY = 512


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is. NULL stays NULL."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def find_exact(docs: DataFrame, tracked: int = TRACKED, heavy: int = HEAVY) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; NULL counts as empty, so all
    NULL and empty texts form one group. The largest doc_id stays. Repeated rows with the same
    doc_id count as copies of each other: exactly one of them is kept. A NULL doc_id is smaller than any other. An empty
    table gives an empty result. Other columns of ``docs`` are ignored, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    digests = scratch.write(
        docs.select(
            "doc_id",
            F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256).alias("text_sha256"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "digests",
    )
    candidates = digests.agg(
        F.expr(f"approx_top_k(text_sha256, {heavy}, {tracked})").alias("top")
    ).select(F.inline("top").alias("text_sha256", "estimate"))
    winners = scratch.write(
        digests.join(F.broadcast(candidates.select("text_sha256")), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")),
        "winners",
    )
    marked = digests.join(F.broadcast(winners), "text_sha256", "left")
    group = Window.partitionBy("text_sha256")
    rest = (
        marked.where(F.col("group_size").isNull())
        .withColumn("best", F.max(F.struct("doc_id", "row")).over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    settled = marked.where(F.col("group_size").isNotNull())
    return settled.unionByName(rest).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("best.row") == F.col("row")).alias("kept"),
        "text_sha256",
    )


def _bit(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(BITS))


def _maps(repeated: DataFrame) -> DataFrame:
    """A bit for every digest, in maps of 32768 bits; :data:`BITS` bits at most, whatever the rows."""
    bit = _bit(F.col("text_sha256"))
    return repeated.groupBy(F.floor(bit / _MAP).alias("__map")).agg(
        F.bitmap_construct_agg(bit % _MAP).alias("__bits")
    )


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.substring(bits, (F.floor(bit % _MAP / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.coalesce(F.floor(value / F.pow(F.lit(2), bit % 8)) % 2 == 1, F.lit(False))


def drop_exact(docs: DataFrame, tracked: int = TRACKED, heavy: int = HEAVY) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one per different text.

    Whole rows are shuffled only where their text occurs again: copies of the most frequent texts are dropped in the map
    task by the broadcast winners, and a map of bits lets rows through whose digest occurs once. Of rows that
    agree in doc_id and text the one with the smallest hash of all columns stays. NULL and empty texts are
    copies of each other, and an empty table stays empty.
    """
    scratch = Scratch(docs.sparkSession, "drop-exact")
    found = scratch.write(find_exact(docs, tracked, heavy).drop("keep_id"), "found").where("group_size > 1")
    kept = found.where("kept").select("text_sha256", "doc_id", "group_size")
    winners = kept.orderBy(F.desc("group_size"), "text_sha256").limit(heavy)
    winners = winners.select(F.col("text_sha256").alias("__digest"), F.col("doc_id").alias("__keep"), F.lit(True).alias("__won"))
    digest = F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256)
    rows = docs.select(F.struct(*docs.columns).alias("__row"), F.col("doc_id").alias("__id"), digest.alias("__digest"))
    rows = rows.join(F.broadcast(winners), "__digest", "left")
    rows = rows.where(F.col("__won").isNull() | F.col("__id").eqNullSafe(F.col("__keep")))
    rows = rows.withColumn("__bit", _bit(F.col("__digest"))).withColumn("__map", F.floor(F.col("__bit") / _MAP))
    rows = rows.join(F.broadcast(_maps(found)), "__map", "left")
    again = _is_set(F.col("__bits"), F.col("__bit"))
    single = rows.where(~again).select("__row.*")

    def key(digest: str, doc_id: str) -> Column:
        return F.concat_ws(":", digest, F.col(doc_id).cast("string"))

    # a digest that occurs once may share its bit with another one: its key is not among those that go
    gone = found.select(key("text_sha256", "doc_id").alias("__key")).distinct()
    stay = kept.select(key("text_sha256", "doc_id").alias("__key"), F.lit(True).alias("__stays"))
    fate = gone.join(stay, "__key", "left")
    content = F.md5(F.to_json("__row"))
    copies = rows.where(again).select("__row", key("__digest", "__id").alias("__key"), content.alias("__content"))
    copies = copies.join(fate.withColumn("__known", F.lit(True)), "__key", "left")
    copies = copies.where("__known IS NULL OR __stays")
    first = Window.partitionBy("__key").orderBy("__content")
    copies = copies.withColumn("__n", F.row_number().over(first)).where("__n = 1")
    return single.unionByName(copies.select("__row.*"))
