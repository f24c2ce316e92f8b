"""Removal of word sequences that stand earlier in the corpus.

Every window of a fixed number of words gets a Rabin-Karp hash. Documents are laid out in the order of their
ids, in chunks. A chunk sends each of its distinct hashes once, sorted and packed, to the bucket of
its leading bits; a bucket tells each chunk which hashes an earlier chunk has too, as one bit per hash. Within
the chunk all but the first window of a hash are repeats anyway. Overlapping repeated windows merge into
maximal intervals, which are cut out of the text.

Only hashes and bits are shuffled after the layout. Chunks lie in a table bucketed by chunk, so that the bits come
to the texts and the texts stay where they are.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.arrowtext import RUN_BYTES, WHITE, cuts_between, coded, flat, runs
from ticketlens.llm.scratch import Scratch

#: Packed hashes that meet in one task, in bytes; a window takes between six and seven.
BUCKET_BYTES = 24 << 20

# Fixed odd numbers: the base of the rolling hash and a second one, both modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

_CHUNKS = "chunk long, doc_ids array<bigint>, texts array<string>, n_bytes long"
_RESULT = """doc_id long, n_words long, n_removed long, removed array<struct<from:bigint,until:bigint>>, kept string"""


def _pack_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in their order to chunks, numbered so that later documents have larger numbers."""
    chunk = TaskContext.get().partitionId() << 33
    held: list[pa.RecordBatch] = []
    size = 0
    for run in runs(batches):
        own = run.column("text").nbytes
        if held and size + own > RUN_BYTES:
            yield _chunk(chunk, held)
            chunk, held, size = chunk + 1, [], 0
        held.append(run)
        size += own
    if held:
        yield _chunk(chunk, held)


def _chunk(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    ids = pa.concat_arrays([run.column("doc_id") for run in held])
    texts = pa.concat_arrays([run.column("text") for run in held])
    whole = [0, len(ids)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number]),
            pa.ListArray.from_arrays(whole, ids),
            pa.ListArray.from_arrays(whole, texts),
            pa.array([pc.sum(pc.binary_length(texts)).as_py() or 0], pa.int64()),
        ],
        names=["chunk", "doc_ids", "texts", "n_bytes"],
    )


class Windows:
    """Words of a column of texts, and the hashes of their windows."""

    def __init__(self, texts: pa.Array, width: int):
        self.data, starts = flat(texts)
        white = WHITE[self.data]
        begin = np.flatnonzero(cuts_between(white, starts))
        end = np.append(begin[1:], len(self.data))
        inside = ~white[begin] if len(begin) else np.zeros(0, bool)
        self.begin, self.end = begin[inside], end[inside]
        self.codes, self.distinct = coded(self.data, self.begin, self.end, ~white)
        #: where each text's words start, with one entry more for the end
        self.bounds = np.searchsorted(self.begin, starts)
        lengths = np.diff(self.bounds)
        counts = np.maximum(lengths - width + 1, 0)
        total = int(counts.sum())
        ends = np.cumsum(counts)
        #: the word that each window starts with
        self.starts = np.repeat(self.bounds[:-1] - (ends - counts), counts) + np.arange(total)
        self.width = width

    def hashes(self, which: int) -> np.ndarray:
        """Rabin-Karp hashes modulo 2**64 of all windows, from prefix sums of the words' hashes.

        The sum from ``s`` on of ``word[k] * base**k`` is divided by ``base**s``; the base is odd, so
        it has an inverse.
        """
        seed = which + 1
        of_word = np.fromiter(
            (xxhash.xxh3_64_intdigest(word, seed) for word in self.distinct.to_pylist()),
            np.uint64,
            len(self.distinct),
        )
        n = len(self.codes)
        base = _BASES[which]
        powers = _powers(base, n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(of_word[self.codes] * powers[:n], out=sums[1:])
        found = sums[self.starts + self.width] - sums[self.starts]
        found *= _powers(pow(base, -1, 1 << 64), n + 1)[self.starts]
        # the sum's low bits depend on the words' low bits alone: mix, so that leading bits are even
        found ^= found >> np.uint64(32)
        found *= np.uint64(0xD6E8FEB86659FD93)
        found ^= found >> np.uint64(32)
        return found


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, np.uint64(base))
    if n:
        factors[0] = 1
    return np.multiply.accumulate(factors)


class Layout:
    """How hashes are dealt to buckets and packed, from the bytes of the corpus alone.

    A window has 64 bits and as many bytes of a second hash as make a wrong pair of equal ones less likely
    than one in a thousand in the whole corpus, were every second byte the start of a window.
    """

    def __init__(self, n_bytes: int, bucket_bytes: int):
        windows = max(2, n_bytes // 2)
        self.extra = max(0, math.ceil((2 * math.log2(windows) + 10 - 64) / 8))
        buckets = max(1, -(-n_bytes * (7 + self.extra) // (6 * bucket_bytes)))
        self.bits = max(0, math.ceil(math.log2(buckets)))

    def keys(self, windows: Windows) -> tuple[np.ndarray, np.ndarray | None]:
        first = windows.hashes(0)
        if not self.extra:
            return first, None
        return first, windows.hashes(1) >> np.uint64(64 - 8 * self.extra)

    def ordered(self, windows: Windows):
        """The order of the windows by key, and where a new key begins in it."""
        first, second = self.keys(windows)
        order = np.argsort(first, kind="stable") if second is None else np.lexsort((second, first))
        first = first[order]
        new = np.ones(len(first), bool)
        new[1:] = first[1:] != first[:-1]
        if second is not None:
            second = second[order]
            new[1:] |= second[1:] != second[:-1]
            second = second[new]
        return order, new, first[new], second

    def split(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The buckets that occur among sorted keys, and where each begins, with the end."""
        bucket = first >> np.uint64(64 - self.bits) if self.bits else np.zeros(len(first), np.uint64)
        at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(first) else np.zeros(0, np.int64)
        return bucket[at].astype(np.int64), np.append(at, len(first))


def _pack(sorted_keys: np.ndarray, skip: int) -> tuple[bytes, bytes, int]:
    """Sorted numbers without their first ``skip`` bits, in Elias-Fano form: low bits as they are, and the rest
    as gaps of a bit vector. Takes about two bits and a half a number more than the least possible."""
    bits = 64 - skip
    low = max(0, bits - max(0, int(math.log2(len(sorted_keys)))))
    low = -(-low // 8) * 8
    own = sorted_keys & np.uint64((1 << bits) - 1) if bits < 64 else sorted_keys
    if low >= 64:
        return own.astype("<u8").tobytes(), b"", 64
    bytes_ = own.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : low // 8]
    high = (own >> np.uint64(low)).astype(np.int64)
    marks = np.zeros(int(high[-1]) + len(own), bool)
    marks[high + np.arange(len(own))] = True
    return np.ascontiguousarray(bytes_).tobytes(), np.packbits(marks, bitorder="little").tobytes(), low


def _unpack(lows: bytes, gaps: bytes, low: int, n: int) -> np.ndarray:
    if low >= 64:
        return np.frombuffer(lows, "<u8").astype(np.uint64)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, : low // 8] = np.frombuffer(lows, np.uint8).reshape(n, low // 8)
    marks = np.unpackbits(np.frombuffer(gaps, np.uint8), bitorder="little")
    high = np.flatnonzero(marks)[:n] - np.arange(n)
    return wide.view("<u8").ravel() | (high.astype(np.uint64) << np.uint64(low))


_MESSAGES = "bucket long, chunk long, n long, low int, lows binary, gaps binary, more binary"
_REPLIES = "chunk long, bucket long, n long, seen binary"


def _texts(batch: pa.RecordBatch, row: int) -> pa.Array:
    return batch.column("texts")[row].values


def _send(layout: Layout, width: int) -> Callable:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, chunk in enumerate(batch.column("chunk").to_pylist()):
                windows = Windows(_texts(batch, row), width)
                _, _, first, second = layout.ordered(windows)
                out = []
                buckets, at = layout.split(first)
                for bucket, begin, end in zip(buckets.tolist(), at[:-1], at[1:], strict=True):
                    lows, gaps, low = _pack(first[begin:end], layout.bits)
                    more = b""
                    if second is not None:
                        wide = second[begin:end].astype("<u8").view(np.uint8).reshape(-1, 8)
                        more = np.ascontiguousarray(wide[:, : layout.extra]).tobytes()
                    out.append((bucket, chunk, end - begin, low, lows, gaps, more))
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        columns, names=["bucket", "chunk", "n", "low", "lows", "gaps", "more"]
                    )

    return send


def _judge(layout: Layout) -> Callable:
    """For each message of a bucket one bit per hash: an earlier chunk has it too."""

    def judge(messages: pa.Table) -> pa.Table:
        messages = messages.sort_by("chunk")
        sizes = messages.column("n").to_numpy()
        keys = np.empty(int(sizes.sum()), np.uint64)
        at = 0
        for n, low, lows, gaps in zip(*(messages.column(c) for c in ("n", "low", "lows", "gaps")), strict=True):
            n = n.as_py()
            keys[at : at + n] = _unpack(lows.as_py(), gaps.as_py(), low.as_py(), n)
            at += n
        if layout.extra:
            raw = b"".join(one.as_py() for one in messages.column("more"))
            wide = np.zeros((len(keys), 8), np.uint8)
            wide[:, : layout.extra] = np.frombuffer(raw, np.uint8).reshape(len(keys), layout.extra)
            second = wide.view("<u8").ravel()
            order = np.lexsort((second, keys))
            second = second[order]
        else:
            order, second = np.argsort(keys, kind="stable"), None
        keys = keys[order]
        same = np.zeros(len(keys), bool)
        same[1:] = keys[1:] == keys[:-1]
        if second is not None:
            same[1:] &= second[1:] == second[:-1]
        seen = np.empty(len(keys), bool)
        seen[order] = same
        ends = np.cumsum(sizes)
        bits = [
            np.packbits(seen[end - n : end]).tobytes() for n, end in zip(sizes, ends, strict=True)
        ]
        return pa.table(
            {
                "chunk": messages.column("chunk"),
                "bucket": messages.column("bucket"),
                "n": messages.column("n"),
                "seen": pa.array(bits, pa.binary()),
            }
        )

    return judge


def _cover(windows: Windows, repeated: np.ndarray) -> np.ndarray:
    """Words that lie in a repeated window."""
    steps = np.zeros(len(windows.codes) + 1, np.int64)
    at = windows.starts[repeated]
    steps[at] += 1
    steps[at + windows.width] -= 1
    return np.cumsum(steps[:-1]) > 0


def _intervals(gone: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """Per text the maximal runs of removed words, counted from the text's first."""
    n = len(gone)
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    inner = gone[1:] & gone[:-1] & ~edge[1:n] if n else gone
    begin = np.flatnonzero(gone & ~np.append(False, inner)[:n])
    end = np.flatnonzero(gone & ~np.append(inner, False)[:n]) + 1
    text = np.searchsorted(bounds, begin, side="right") - 1
    offsets = np.searchsorted(text, np.arange(len(bounds)))
    base = bounds[text]
    spans = pa.StructArray.from_arrays([pa.array(begin - base), pa.array(end - base)], names=["from", "until"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)


def _kept(windows: Windows, gone: np.ndarray) -> pa.Array:
    """Per text the words that stay, joined by one space."""
    stays = ~gone
    begin, end = windows.begin[stays], windows.end[stays]
    of_text = np.searchsorted(windows.bounds, np.flatnonzero(stays), side="right") - 1
    bounds = np.searchsorted(of_text, np.arange(len(windows.bounds)))
    first = np.zeros(len(begin), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    lengths = end - begin + ~first  # with the space before it
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    out = np.full(total, 32, np.uint8)
    letters = np.ones(total, bool)
    letters[(ends - lengths)[~first]] = False
    marks = np.zeros(len(windows.data) + 1, np.int8)
    marks[begin] += 1
    marks[end] -= 1  # where a text ends with a word, the next one may begin with one
    out[letters] = windows.data[np.cumsum(marks[:-1]).astype(bool)]
    offsets = np.append(0, ends)[bounds]
    made = pa.Array.from_buffers(
        pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)]
    )
    return made.cast(pa.string())


def _cut(layout: Layout, width: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers = batch.column("answers").to_pylist()
            for row in range(batch.num_rows):
                windows = Windows(_texts(batch, row), width)
                order, new, first, _ = layout.ordered(windows)
                seen = np.zeros(len(first), bool)
                buckets, at = layout.split(first)
                place = dict(zip(buckets.tolist(), at[:-1].tolist(), strict=True))
                for answer in answers[row] or ():
                    begin, n = place[answer["bucket"]], answer["n"]
                    bits = np.unpackbits(np.frombuffer(answer["seen"], np.uint8))[:n]
                    seen[begin : begin + n] = bits
                # the order is stable, so the first of equal keys is the first in the chunk
                repeated = np.empty(len(order), bool)
                repeated[order] = ~new | seen[np.cumsum(new) - 1]
                gone = _cover(windows, repeated)
                lost = np.append(0, np.cumsum(gone))
                bounds = windows.bounds
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[row].values,
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(np.diff(lost[bounds]), pa.int64()),
                        _intervals(gone, bounds),
                        _kept(windows, gone),
                    ],
                    names=["doc_id", "n_words", "n_removed", "removed", "kept"],
                )

    return cut


def remove_repeats(docs: DataFrame, width: int = 20, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, removed (intervals of words), kept.

    A word goes when a window of ``width`` words covers it whose words stand, in their order, in an earlier
    window too: in a document with a smaller doc_id, or earlier in the same one. Words are separated by
    ASCII white space and compared as they are; ``kept`` has the rest, joined by one space. All windows
    are judged on the texts as given. A NULL text has no words. A NULL doc_id is smaller than
    any other; rows with the same doc_id count one after the other, in the order of a hash of their texts, so
    of repeated rows one stays whole. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "substrings")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64("text").alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["doc_id", "hash", "row"]
    laid = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    table = f"substrings_{uuid.uuid4().hex}"
    n_tables = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid.select("doc_id", "text").mapInArrow(_pack_chunks, _CHUNKS).write.option(
        "path", scratch.path("chunks")
    ).option("compression", "zstd").bucketBy(n_tables, "chunk").saveAsTable(table)
    chunks = spark.table(table)
    layout = Layout(chunks.agg(F.sum("n_bytes")).first()[0] or 0, bucket_bytes)
    sent = chunks.select("chunk", "texts").mapInArrow(_send(layout, width), _MESSAGES)
    replies = sent.groupBy("bucket").applyInArrow(_judge(layout), _REPLIES)
    answers = scratch.write(
        replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", "seen")).alias("answers")), "answers"
    )
    ready = chunks.join(answers.hint("shuffle_hash"), "chunk", "left")
    # the plan knows the files; they stay until the application ends, the name need not
    spark.sql(f"DROP TABLE {table}")
    return ready.select("doc_ids", "texts", "answers").mapInArrow(_cut(layout, width), _RESULT)
