"""Rank, dense rank and tiles over any number of entities without one task seeing them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import pinned

# Rows of a slice, where that makes more slices than there are shuffle partitions.
SLICE_ROWS = 500_000


def tile_of(position: Column, rows: Column, tiles: int) -> Column:
    """Tile of a 1-based position when ``rows`` rows are dealt to ``tiles`` tiles.

    Sizes differ by at most one and the larger tiles come first.
    """
    size = _div(rows, F.lit(tiles))
    larger = rows % tiles
    in_larger = larger * (size + 1)
    rest = _div(position - 1 - in_larger, F.nullif(size, F.lit(0).cast("bigint")))
    return F.when(position <= in_larger, _div(position - 1, size + 1) + 1).otherwise(
        larger + rest + 1
    )


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def rank_entities(
    df: DataFrame,
    score: str,
    tiebreak: tuple[str, ...],
    tiles: int = 4,
    names: tuple[str, str, str] = ("rank", "dense_rank", "tile"),
) -> DataFrame:
    """Rank rows by descending score; tiles are dealt in the order of score, then ``tiebreak``.

    The score must not be NULL and the tie-break must be unique. Rows are ranked in slices, whatever
    their number.
    """
    order = [F.col(score).desc(), *[F.col(c).asc() for c in tiebreak]]
    rows, ranks = _ranks_in_slices(df, score, order, tiles)
    named = [c.cast("bigint").alias(n) for c, n in zip(ranks, names, strict=True)]
    return rows.select(*df.columns, *named)


def top_ranked(
    df: DataFrame,
    score: str,
    tiebreak: tuple[str, ...],
    n: int,
    tiles: int = 4,
    names: tuple[str, str, str] = ("rank", "dense_rank", "tile"),
) -> DataFrame:
    """The first ``n`` rows of :func:`rank_entities`, with the same ranks and tiles, without ranking the rest.

    Every row with a greater score stands before a row, so the ranks of the first ``n`` follow from them alone, and
    a tile follows from the place and one count. Each task keeps its ``n`` best rows; ``n`` should be small.
    """
    order = [F.col(score).desc(), *[F.col(c).asc() for c in tiebreak]]
    best = df.orderBy(*order).limit(n)
    line = Window.orderBy(*order)  # over n rows
    by_score = Window.orderBy(order[0])
    ranks = (
        F.rank().over(by_score),
        F.dense_rank().over(by_score),
        tile_of(F.row_number().over(line).cast("bigint"), df.agg(F.count("*")).scalar(), tiles),
    )
    named = [c.cast("bigint").alias(name) for c, name in zip(ranks, names, strict=True)]
    return best.select(*df.columns, *named)


def tile_sizes(df: DataFrame, tiles: int = 4, names: tuple[str, str] = ("tile", "rows")) -> DataFrame:
    """How many rows fall into each tile that has any: one count says it, whatever the order."""
    counted = df.agg(F.count("*").alias("_rows"))
    each = _div(F.col("_rows"), F.lit(tiles).cast("bigint"))
    sizes = [
        F.struct(
            F.lit(tile).cast("bigint").alias(names[0]),
            (each + F.when(F.col("_rows") % tiles >= tile, 1).otherwise(0)).cast("bigint").alias(names[1]),
        )
        for tile in range(1, tiles + 1)
    ]
    return counted.select(F.inline(F.array(*sizes))).where(F.col(names[1]) > 0)


def _in_slices(df: DataFrame, order: list[Column], slices: int | None = None) -> DataFrame:
    """The rows range-partitioned by the order, written once so that every reader sees one split.

    Each task sorts its slice before it is written, so a row's place in its slice is its place in the file. Without
    ``slices`` there are as many as shuffle partitions, and small ones are joined.
    """
    ranged = df.repartitionByRange(*order) if slices is None else df.repartitionByRange(slices, *order)
    # the upper bits of the id are the task's number, the lower ones count its rows
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    placed = ranged.sortWithinPartitions(*order).withColumns({"_slice": F.spark_partition_id(), "_row": place})
    return pinned(placed, "slices")


def numbered_in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows with their place in the order, from 1, without one task seeing them all.

    Rows are shuffled once, into slices whose number follows the rows; a summary row per slice gives the offset.
    """
    slices = -(-df.count() // SLICE_ROWS)
    more = slices > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = _in_slices(df, order, slices) if more else _in_slices(df, order)
    sizes = placed.groupBy("_slice").agg(F.count("*").alias("_rows"))
    # one row per slice
    line = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_slice", F.coalesce(F.sum("_rows").over(line), F.lit(0)).alias("_before"))
    rows = placed.join(F.broadcast(before), "_slice")
    return rows.select(*df.columns, (F.col("_before") + F.col("_row")).alias(name))


def _ranks_in_slices(df: DataFrame, score: str, order: list[Column], tiles: int):
    """Rank every slice of the rows ranged by score and tie-break, and add offsets.

    With the tie-break in the range, many equal scores spread over several slices. One summary row
    per slice then tells how many rows and scores precede it, and where the score it starts with began.
    """
    # By its number's hash a slice would meet others in a task. Ranges half a slice wide keep them apart, and there
    # are never more ranges than slices.
    ranges = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = _in_slices(df, order).repartitionByRange(ranges, "_slice")
    here = Window.partitionBy("_slice")
    local = placed.select(
        "*",
        F.rank().over(here.orderBy(order[0])).alias("_rank"),
        F.dense_rank().over(here.orderBy(order[0])).alias("_dense"),
    )
    # One row per slice, at most as many as there are shuffle partitions: safe to broadcast.
    rows = local.join(F.broadcast(_slice_offsets(local, score)), "_slice")
    rank = F.when(F.col(score) == F.col("_first"), F.col("_first_rank")).otherwise(
        F.col("_rows_before") + F.col("_rank")
    )
    dense = F.col("_scores_before") + F.col("_dense")
    tile = tile_of(F.col("_rows_before") + F.col("_row"), F.col("_all_rows"), tiles)
    return rows, (rank, dense, tile)


def _slice_offsets(local: DataFrame, score: str) -> DataFrame:
    spans = local.groupBy("_slice").agg(
        F.count("*").alias("_rows"),
        F.max(score).alias("_first"),
        F.min(score).alias("_last"),
        F.max("_rank").alias("_last_start"),
        F.max("_dense").alias("_scores"),
    )
    # These windows run over the summary rows only, one per slice.
    line = Window.orderBy("_slice")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    continues = F.coalesce(F.col("_first") == F.lag("_last").over(line), F.lit(False))
    placed = (
        spans.withColumn("_continues", continues.cast("bigint"))
        .withColumn("_rows_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .withColumn(
            "_scores_before",
            F.coalesce(F.sum(F.col("_scores") - F.col("_continues")).over(before), F.lit(0))
            - F.col("_continues"),
        )
        .withColumn("_all_rows", F.sum("_rows").over(Window.partitionBy()))
    )
    # Where the last score of a slice began, which may be several slices earlier.
    began = F.min(F.col("_rows_before") + F.col("_last_start")).over(Window.partitionBy("_last"))
    started = placed.withColumn("_last_rank", began)
    first_rank = F.when(F.col("_continues") == 1, F.lag("_last_rank").over(line)).otherwise(
        F.col("_rows_before") + 1
    )
    return started.select(
        "_slice",
        "_first",
        first_rank.alias("_first_rank"),
        "_rows_before",
        "_scores_before",
        "_all_rows",
    )
