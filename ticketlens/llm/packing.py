"""Best-fit packing of documents into sequences of a fixed capacity.

Pieces above a third of the capacity are large: at most two go into one sequence, matched greedily,
the longest with the longest that fits beside it. Smaller pieces then go, longest first, into the
tightest gap that takes them.

The packing needs only how many pieces there are of each length. These counts, one per length, are
planned on the driver in runs: so many pieces of a length, from a rank on, fill sequences from a
number on. Pieces then find their sequence by their rank among those of their length, which is the rank within
their task plus the pieces of the tasks before it. No piece and no sequence passes the driver.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.arrowtext import runs
from ticketlens.llm.scratch import Scratch
from ticketlens.llm.token_ids import encoder

CAPACITY = 1024

_PIECES = """doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"""
_RUNS = "length long, first long, n long, sequence long, each long, offset long"


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, pieces per sequence, offset) from the counts.

    Piece ``rank`` of a run lies in sequence ``sequence + (rank - first) // each`` at ``offset + length *
    ((rank - first) % each)``.
    """
    left = {length: n for length, n in counts.items() if n}
    used = dict.fromkeys(left, 0)
    found: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free tokens: runs of (first sequence, sequences)
    sizes: list[int] = []  # the gaps that occur, ascending
    sequences = 0

    def place(length: int, n: int, sequence: int, each: int, offset: int) -> None:
        found.append((length, used[length], n, sequence, each, offset))
        used[length] += n
        left[length] -= n

    def open_gap(free: int, sequence: int, n: int) -> None:
        if free and n:
            if free not in gaps:
                gaps[free] = []
                insort(sizes, free)
            gaps[free].append((sequence, n))

    large = sorted(length for length in left if 3 * length > capacity)
    for length in reversed(large):
        while left[length]:
            room = capacity - length
            fits = [x for x in large[: bisect_left(large, room + 1)] if left[x] - (x == length) > 0]
            mate = fits[-1] if fits else None
            if mate is None:
                n = left[length]
                place(length, n, sequences, 1, 0)
                open_gap(room, sequences, n)
            else:
                n = left[length] // 2 if mate == length else min(left[length], left[mate])
                place(length, n, sequences, 1, 0)
                place(mate, n, sequences, 1, length)
                open_gap(room - mate, sequences, n)
            sequences += n

    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                each = capacity // length
                n = max(1, left[length] // each)
                open_gap(capacity, sequences, n)
                sequences += n
                continue
            free = sizes[at]
            first, n = gaps[free].pop()
            if not gaps[free]:
                del gaps[free], sizes[at]
            # the tightest gap takes all it can before the next one
            each = min(free // length, left[length])
            filled = min(n, left[length] // each)
            place(length, filled * each, first, each, capacity - free)
            open_gap(free - each * length, first, filled)
            open_gap(free, first + filled, n - filled)
    return found


def _cut(capacity: int, tokenizer: str, end_id: int | None):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in runs(batches):
            ids, counts = tokens.encode(batch.column("text"))
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
                counts = counts + 1
            ends = np.cumsum(counts)
            # a document's first piece takes what whole pieces leave over
            number = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), number)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
            short = (counts - (number - 1) * capacity)[doc]
            start = np.where(piece == 0, 0, short + (piece - 1) * capacity)
            length = np.where(piece == 0, short, capacity)
            order = np.argsort(length, kind="stable")
            rank = np.empty(len(length), np.int64)
            in_order = length[order]
            fresh = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]])) if len(
                length
            ) else np.zeros(0, np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(
                fresh, np.diff(np.append(fresh, len(length)))
            )
            rank += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            raw = memoryview(ids.astype("<u4").tobytes())
            begin = (ends - counts)[doc] + start
            sums = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(begin, length, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(np.full(len(doc), part), pa.int32()),
                    pa.array(rank),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"],
            )

    return cut


def pack(
    docs: DataFrame, tokenizer: str, end_id: int | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Documents longer than the capacity are cut into pieces of it, the first of which may be shorter.
    NULL and empty texts hold the end id alone, or no piece where there is none. Rows that repeat a
    doc_id are packed each; an empty table gives an empty result; other columns are ignored. Offsets in
    a sequence have no gaps. The checksum is over the piece's ids as 32-bit integers.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = docs.select("doc_id", "text").mapInArrow(_cut(capacity, tokenizer, end_id), _PIECES)
    pieces = scratch.write(cut, "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {row["length"]: row["n"] for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # one row per run; their number is bounded by the capacity, not by the documents
    runs_ = spark.createDataFrame(plan(counts, capacity), _RUNS)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    at = F.col("rank") - F.col("first")
    return ranked.join(
        F.broadcast(runs_.withColumnRenamed("length", "run_length")),
        (F.col("length") == F.col("run_length")) & (at >= 0) & (at < F.col("n")),
    ).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.floor(at / F.col("each"))).alias("sequence_id"),
        (F.col("offset") + F.col("length") * (at % F.col("each"))).alias("offset"),
    )
