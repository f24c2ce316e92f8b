"""Token ids as binary output: static range asymmetric numeral coding.

One table of frequencies, counted over the whole corpus, is shared by all blocks. A block holds whole
documents and stands alone: its ids are dealt to lanes that are coded side by side, position by
position. Every few steps it keeps a checkpoint: the lanes' states and the place in the payload. The
stretch of a block from one checkpoint to the next is a row of its own, with its states, its part of the
payload, the documents that lie in it and a checksum of its ids, so that any task can decode and verify it
alone, and a long document is decoded by many.

The output is a folder with two Parquet tables: ``table`` (id, frequency) and ``stretches``. Stretches are
ordered by part, block and number within it; in that order their documents are in ascending doc_id order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.llm.scratch import Scratch
from ticketlens.llm.token_ids import encode_rows

LANES = 1024
#: Steps of all lanes between two checkpoints.
CHECKPOINT = 128
#: A block holds whole documents up to one stretch; a longer document is a block of several stretches.
BLOCK_IDS = CHECKPOINT * LANES
#: Frequencies add up to 2 ** SCALE.
SCALE = 20
_WORD = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)
_FLOOR = np.uint64(1 << 31)

#: ``first``: the ids of the part before the stretch. ``begins`` and ``lengths`` describe the whole
#: documents that have ids in the stretch, by their place in the part.
_STRETCHES = """part int, block int, stretch int, first long, n_ids long, doc_ids array<bigint>,
begins array<bigint>, lengths array<bigint>, states binary, payload binary, crc32 long"""


def scaled(ids: np.ndarray, counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies of the ids that occur, 1 at least, with the sum 2 ** scale."""
    if not len(ids):
        return np.zeros(0, np.int64)
    room = (1 << scale) - len(ids)
    if room < 0:
        raise ValueError("more ids than places in the table: use a larger scale")
    total = int(counts.sum())
    share = np.array([1 + int(n) * room // total for n in counts], np.int64)
    share[int(np.argmax(counts))] += (1 << scale) - int(share.sum())
    return share


class Coder:
    """Coding and decoding by one table."""

    def __init__(self, ids: np.ndarray, frequency: np.ndarray, scale: int = SCALE):
        size = int(ids.max()) + 1 if len(ids) else 0
        self.scale = np.uint64(scale)
        self.frequency = np.zeros(size, np.uint64)
        self.frequency[ids] = frequency
        self.first = np.zeros(size, np.uint64)
        self.first[ids] = np.cumsum(frequency) - frequency
        self.slots = np.repeat(ids.astype(np.uint32), frequency)

    def encode(self, ids: np.ndarray):
        """States and payload as bytes, and the checkpoints as (step, word, states) in order."""
        states = np.full(LANES, _FLOOR, np.uint64)
        steps = -(-len(ids) // LANES)
        chunks, marks = [], []
        limit = np.uint64(63) - self.scale
        for step in range(steps - 1, -1, -1):
            now = ids[step * LANES : (step + 1) * LANES]
            frequency, first = self.frequency[now], self.first[now]
            state = states[: len(now)]
            over = state >= (frequency << limit)
            chunks.append((state[over] & _LOW).astype("<u4"))
            state[over] >>= _WORD
            times = state // frequency
            states[: len(now)] = (times << self.scale) + (state - times * frequency) + first
            if step and step % CHECKPOINT == 0:
                marks.append((step, states.copy()))
        chunks.reverse()
        words = np.cumsum([0, *map(len, chunks)])
        payload = np.concatenate(chunks) if chunks else np.zeros(0, "<u4")
        kept = [(step, int(words[step]), at.astype("<u8")) for step, at in reversed(marks)]
        return states.astype("<u8").tobytes(), payload.tobytes(), kept

    def _segment(self, payload, word: int, states: np.ndarray, n: int) -> np.ndarray:
        """``n`` ids from one checkpoint on."""
        out = np.empty(n, np.uint32)
        mask = np.uint64((1 << int(self.scale)) - 1)
        states = states.copy()
        for at in range(0, n, LANES):
            state = states[: min(LANES, n - at)]
            slot = state & mask
            now = self.slots[slot]
            out[at : at + len(now)] = now
            state = self.frequency[now] * (state >> self.scale) + slot - self.first[now]
            need = state < _FLOOR
            more = int(np.count_nonzero(need))
            state[need] = (state[need] << _WORD) | payload[word : word + more]
            word += more
            states[: len(state)] = state
        return out

    def stretches(self, ids: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
        """The stretches of a block: first id, number of ids, states at its start, payload."""
        states, payload, marks = self.encode(ids)
        starts = [(0, 0, np.frombuffer(states, "<u8")), *marks]
        for (step, word, at), (following, until, _) in zip(
            starts, [*starts[1:], (None, len(payload) // 4, None)], strict=True
        ):
            first = step * LANES
            end = len(ids) if following is None else following * LANES
            yield first, end - first, at.tobytes(), payload[4 * word : 4 * until]

    def decode(self, n: int, states: bytes, payload: bytes) -> np.ndarray:
        """The ids of one stretch. A damaged payload gives other ids or a ValueError."""
        words = np.frombuffer(payload, "<u4").astype(np.uint64)
        return self._segment(words, 0, np.frombuffer(states, "<u8"), n)


def count_ids(encoded: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur and how often; as many rows as the vocabulary has come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                seen += np.bincount(np.frombuffer(ids.as_buffer(), "<u2"), minlength=1 << 16)
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(seen[found])], names=["id", "n"])

    rows = encoded.select("ids").mapInArrow(count, "id long, n long")
    totals = sorted(rows.groupBy("id").agg(F.sum("n").alias("n")).collect())
    table = np.array([tuple(row) for row in totals], np.int64).reshape(-1, 2)
    return table[:, 0], table[:, 1]


def _to_stretches(ids: np.ndarray, frequency: np.ndarray, scale: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = Coder(ids, frequency, scale), TaskContext.get().partitionId()
        block, first, held, size = 0, 0, [], 0

        def close():
            tokens = np.concatenate([one for _, one in held])
            docs = np.array([doc is None for doc, _ in held])
            names = np.array([doc or 0 for doc, _ in held], np.int64)
            ends = np.cumsum([len(one) for _, one in held])
            for stretch, (at, n, states, payload) in enumerate(coder.stretches(tokens)):
                low, high = np.searchsorted(ends, at, "right"), np.searchsorted(ends, at + n) + 1
                lengths = np.diff(ends[low:high], prepend=ends[low - 1] if low else 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([block], pa.int32()),
                        pa.array([stretch], pa.int32()),
                        pa.array([first + at]),
                        pa.array([n], pa.int64()),
                        _list(pa.array(names[low:high], mask=docs[low:high])),
                        _list(pa.array(first + ends[low:high] - lengths)),
                        _list(pa.array(lengths)),
                        pa.array([states], pa.binary()),
                        pa.array([payload], pa.binary()),
                        pa.array([zlib.crc32(tokens[at : at + n].astype("<u4").tobytes())], pa.int64()),
                    ],
                    names=_NAMES,
                )

        for batch in batches:
            for doc, packed in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                tokens = np.frombuffer(packed.as_buffer(), "<u2")
                if held and size + len(tokens) > BLOCK_IDS:
                    yield from close()
                    block, first, held, size = block + 1, first + size, [], 0
                held.append((doc, tokens))
                size += len(tokens)
        if held:
            yield from close()

    return encode


_NAMES = [column.split()[0] for column in _STRETCHES.split(",")]


def _list(values: pa.Array) -> pa.Array:
    """One row that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(pa.int64()))


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, scale: int = SCALE) -> None:
    """Writes the ids of all documents to the folder ``path``, in ascending doc_id order.

    A NULL text counts as empty and gives the end id alone; a NULL doc_id comes first; rows that
    repeat a doc_id are kept side by side, each with its ids. An empty table gives empty output tables.
    Other columns are ignored. The vocabulary must be below 65,536.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-ids")
    encoded = scratch.write(encode_rows(docs, tokenizer, end_id), "ids")
    ids, counts = count_ids(encoded)
    frequency = scaled(ids, counts, scale)
    table = pa.table({"id": ids, "frequency": frequency}).to_pandas()
    spark.createDataFrame(table, "id long, frequency long").coalesce(1).write.parquet(f"{path}/table")
    ordered = encoded.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    stretches = ordered.mapInArrow(_to_stretches(ids, frequency, scale), _STRETCHES)
    # payloads are coded already; what is left is not worth packing
    stretches.write.option("compression", "uncompressed").parquet(f"{path}/stretches")
    scratch.drop("ids")


_DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def read_ids(spark: SparkSession, path: str, scale: int = SCALE) -> DataFrame:
    """Per document, decoded from the files: doc_id, start, n_tokens, ids_crc32, ids (32 bits each).

    Stretches are dealt to tasks whatever file they lie in. Each is decoded and verified alone; one whose
    ids differ from its checksum stops the job. Documents that lie within a stretch are ready then. Those
    that cross checkpoints, which are longer than a stretch, are put together after a shuffle of their pieces.
    """
    listed = spark.read.schema("id long, frequency long").parquet(f"{path}/table").collect()
    table = np.array(sorted(tuple(row) for row in listed), np.int64).reshape(-1, 2)
    ids, frequency = table[:, 0], table[:, 1]
    stretches = spark.read.schema(_STRETCHES).parquet(f"{path}/stretches")
    # one number per written part: the ids of all parts before it
    sizes = dict(stretches.groupBy("part").agg(F.sum("n_ids")).collect())
    before, at = {}, 0
    for part in sorted(sizes):
        before[part] = at
        at += sizes[part]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(ids, frequency, scale)
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                where = f"stretch {one['stretch']} of block {one['block']} of part {one['part']}"
                raw = coder.decode(one["n_ids"], one["states"], one["payload"]).astype("<u4").tobytes()
                if zlib.crc32(raw) != one["crc32"]:
                    raise ValueError(f"{where} is damaged")
                begins, lengths = np.array(one["begins"], np.int64), np.array(one["lengths"], np.int64)
                low = np.maximum(begins, one["first"])
                high = np.minimum(begins + lengths, one["first"] + one["n_ids"])
                spans = zip(low - one["first"], high - one["first"], strict=True)
                pieces = [raw[4 * a : 4 * b] for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one["doc_ids"], pa.int64()),
                        pa.array(begins + before[one["part"]]),
                        pa.array(lengths),
                        pa.array([zlib.crc32(piece) for piece in pieces], pa.int64()),
                        pa.array(pieces, pa.binary()),
                        pa.array(low - begins),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids", "at"],
                )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = [sorted((p["at"], p["ids"]) for p in row) for row in batch.column("pieces").to_pylist()]
            whole = [b"".join(piece for _, piece in row) for row in pieces]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in ("doc_id", "start", "n_tokens")],
                    pa.array([zlib.crc32(one) for one in whole], pa.int64()),
                    pa.array(whole, pa.binary()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
            )

    stretches = stretches.repartition("part", "block", "stretch")
    crosses = F.exists(
        F.arrays_zip("begins", "lengths"),
        lambda doc: (doc["begins"] < F.col("first"))
        | (doc["begins"] + doc["lengths"] > F.col("first") + F.col("n_ids")),
    )
    whole = stretches.where(~crosses).mapInArrow(decode, f"{_DOCS}, at long")
    pieces = stretches.where(crosses).mapInArrow(decode, f"{_DOCS}, at long")
    joined = pieces.groupBy("doc_id", "start", "n_tokens").agg(
        F.collect_list(F.struct("at", "ids")).alias("pieces")
    )
    return whole.drop("at").unionByName(joined.mapInArrow(join, _DOCS))
