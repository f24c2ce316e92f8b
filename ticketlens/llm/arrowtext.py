"""Texts of an Arrow column as one run of bytes, cut into pieces by whole-array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in runs of at most this many bytes, or one text if it is longer.
RUN_BYTES = 8 << 20

#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def runs(batches: Iterator[pa.RecordBatch], limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices whose ``text`` fits the limit, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        row = 0
        while row < batch.num_rows:
            before = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(row, stop - row)
            row = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each text starts (one entry more for the end). NULL is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    n, at = len(column), column.offset
    starts = np.frombuffer(column.buffers()[1], np.int64)[at : at + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def cuts_between(kinds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """True where a new piece begins: at another kind of byte, and at each text."""
    cut = np.empty(len(kinds), bool)
    if len(kinds):
        cut[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=cut[1:])
        inner = starts[:-1]
        cut[inner[inner < len(kinds)]] = True
    return cut


def coded(data: np.ndarray, begin: np.ndarray, end: np.ndarray, keep: np.ndarray | None = None):
    """The pieces by number: a number per piece, and the distinct pieces as a binary array.

    ``keep`` marks the bytes that lie in pieces, when there are others.
    """
    size = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(end - begin, out=size[1:])
    held = data if keep is None else data[keep]
    pieces = pa.Array.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(size), pa.py_buffer(np.ascontiguousarray(held))]
    )
    if size[-1] < 2**31:
        pieces = pieces.cast(pa.binary())
    table = pieces.dictionary_encode()
    return table.indices.to_numpy(), table.dictionary


def words(data: np.ndarray, starts: np.ndarray):
    """White-space separated words: numbers, distinct words, and where each text's words start."""
    white = WHITE[data]
    cut = cuts_between(white, starts)
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], len(data))
    inside = ~white[begin] if len(begin) else np.zeros(0, bool)
    begin, end = begin[inside], end[inside]
    codes, distinct = coded(data, begin, end, ~white)
    return codes, distinct, np.searchsorted(begin, starts)


def gather(codes: np.ndarray, table: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each code the run ``table[at[code]:at[code + 1]]``, all in a row, and each run's length."""
    length = (at[1:] - at[:-1])[codes]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    place = np.repeat(at[:-1][codes] - (ends - length), length) + np.arange(total)
    return table[place], length
