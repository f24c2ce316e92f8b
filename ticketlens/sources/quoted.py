"""CSV records with line breaks inside quotes, read in splits.

Whether a line begins inside quotes depends on all quotes before it in its file. One pass counts the quotes per split;
their running sum over a file's splits, a few numbers each, says which splits begin inside a quoted field.
Every task then cuts its split into records on its own. A record that passes the end of its split is left in
fragments, at most two per split, which are put together by file and place.

A file that has no line with an odd number of quotes has no such record and needs none of this.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a piece of text is: a record, or the end, a middle or the beginning of one that passes its split's bounds.
WHOLE, END, MIDDLE, BEGINNING = range(4)

_PIECES = "file string, start long, kind int, record string"


def lines_of(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines with their file and the place of their split in it; a split's lines come in their order."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    )


def _quotes() -> Column:
    return F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))


def files_with_breaks(lines: DataFrame) -> dict[str, bool]:
    """For every file that has lines, whether a quoted field in it holds a line break.

    That is so where a line has an odd number of quotes. A file's path and flag reach the driver.
    """
    found = lines.groupBy("file").agg(F.bool_or(_quotes() % 2 == 1).alias("odd")).collect()
    return {unquote(row["file"]): row["odd"] for row in found}


def open_splits(lines: DataFrame) -> dict[str, dict[int, bool]]:
    """For every split of every file, whether it begins inside quotes.

    A flag per split reaches the driver: for a terabyte in splits of 128 MB that is 8,000.
    """
    counted = lines.groupBy("file", "start").agg((F.sum(_quotes()) % 2).alias("odd"))
    found: dict[str, dict[int, bool]] = {}
    for file, start, odd in sorted(map(tuple, counted.collect())):
        splits = found.setdefault(file, {})
        splits[start] = is_open = splits.pop(-1, False)
        splits[-1] = is_open ^ bool(odd)  # for the next split
    for file, splits in found.items():
        if splits.pop(-1):
            raise ValueError(f"a quoted field is not closed in {file}")
    return found


def _cutter(inside: dict[str, dict[int, bool]], header: Sequence[str]) -> Callable:
    # Written without names of this module, so that executors need not have it.
    import csv

    import numpy as np
    import pyarrow.compute as pc

    names = [name.lower() for name in header]
    whole, end, middle, beginning = WHOLE, END, MIDDLE, BEGINNING

    def checked(records: pa.Array, file: str) -> pa.Array:
        found = next(csv.reader([records[0].as_py().removeprefix("\ufeff")]))
        if [name.lower() for name in found] != names:
            raise ValueError(f"CSV header of {file} names {found}, not {list(header)}")
        return records.slice(1)

    def batch_of(file: str, start: int, kind: int, records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * n), pa.array([start] * n, pa.int64()), pa.array([kind] * n, pa.int32()), records],
            names=["file", "start", "kind", "record"],
        )

    class Split:
        """The records of one split, from its lines in their order."""

        def __init__(self, file: str, start: int):
            if start not in inside.get(file, ()):
                raise ValueError(f"{file} was split differently when its quotes were counted; load it again")
            self.file, self.start = file, start
            self.open = inside[file][start]
            self.in_end = self.open
            self.held: list[str] = []
            self.header = start == 0

        def take(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
            counts = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
            after = (np.cumsum(counts) + self.open) % 2
            ends = np.flatnonzero(after == 0)
            if not len(ends):
                self.held += lines.to_pylist()
                return
            first = int(ends[0]) + 1
            if self.held or self.in_end:
                text = "\n".join([*self.held, *lines.slice(0, first).to_pylist()])
                self.held = []
                yield from self.out(end if self.in_end else whole, pa.array([text]))
                self.in_end = False
                ends = ends[1:]
            else:
                first = 0
            if len(ends):
                stop = int(ends[-1]) + 1
                body = lines.slice(first, stop - first)
                if len(ends) < len(body):
                    offsets = np.concatenate([[0], ends + 1 - first]).astype(np.int32)
                    body = pc.binary_join(pa.ListArray.from_arrays(offsets, body), "\n")
                yield from self.out(whole, body)
                first = stop
            self.held = lines.slice(first).to_pylist()
            self.open = bool(after[-1])

        def out(self, kind: int, records: pa.Array) -> Iterator[pa.RecordBatch]:
            if kind in (whole, end):
                records = pc.utf8_rtrim(records, "\r")
            if kind == whole:
                records = records.filter(pc.not_equal(pc.utf8_trim_whitespace(records), ""))
                if self.header and len(records):
                    records, self.header = checked(records, self.file), False
            if len(records):
                yield batch_of(self.file, self.start, kind, records)

        def close(self) -> Iterator[pa.RecordBatch]:
            if self.held:
                kind = middle if self.in_end else beginning
                yield from self.out(kind, pa.array(["\n".join(self.held)]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            files, starts = batch.column("file"), batch.column("start")
            at = 0
            while at < batch.num_rows:
                here = files[at].as_py(), starts[at].as_py()
                same = pc.and_(pc.equal(files, here[0]), pc.equal(starts, here[1])).to_numpy(zero_copy_only=False)
                others = np.flatnonzero(~same[at:])
                until = at + int(others[0]) if len(others) else batch.num_rows
                if split is None or (split.file, split.start) != here:
                    if split is not None:
                        yield from split.close()
                    split = Split(*here)
                yield from split.take(batch.column("line").slice(at, until - at))
                at = until
        if split is not None:
            yield from split.close()

    return cut


def records_of(spark: SparkSession, files: list[str], header: Sequence[str]) -> DataFrame:
    """The records of files with quoted line breaks, as text in one column ``record``, without headers."""
    lines = lines_of(spark, files)
    inside = open_splits(lines)
    pieces = lines.mapInArrow(_cutter(inside, header), _PIECES)
    records = pieces.where(F.col("kind") == WHOLE).select("record")
    if not any(is_open for splits in inside.values() for is_open in splits.values()):
        return records
    # fragments: two for each split at most, numbered by file
    in_file = Window.partitionBy("file").orderBy("start", F.desc("is_end"))
    fragments = pieces.where(F.col("kind") != WHOLE).withColumn("is_end", F.col("kind") != BEGINNING)
    numbered = fragments.withColumn("n", F.sum(F.when(F.col("kind") == BEGINNING, 1).otherwise(0)).over(in_file))
    parts = F.array_sort(F.collect_list(F.struct("start", "record")))
    joined = numbered.groupBy("file", "n").agg(F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))
    return records.unionByName(joined.select("record"))
