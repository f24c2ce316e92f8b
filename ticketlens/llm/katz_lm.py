"""Katz backoff language model over words, of order two, trained and scored at any size.

P(w | h) is the Good-Turing discounted share of h w among the bigrams of h where that was seen; else it is
alpha(h) P(w), with alpha(h) such that the probabilities after h add up to exactly 1. P(w) is the
discounted share of w; what discounting sets free belongs to all unknown words together.

Texts are kept in chunks of a few megabytes: numbers into the chunk's own list of words. The model's
tables are partitioned, words by their hash and bigrams by their first word. A chunk asks each partition
once for each different word or bigram it holds and says how often it saw it in training; the
partition adds up what all chunks say and answers in the order it was asked. So counting and look-up are one
exchange, and what is exchanged are the different bigrams of each chunk, packed, not the tokens. A
first word so frequent that its bigrams would not fit one partition is spread over several; its
sums are added up by first word and joined back to the chunks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.arrowtext import LOWER, flat, runs, words
from ticketlens.llm.near_dedup import mix
from ticketlens.llm.scratch import Scratch

#: Counts above this are not discounted.
TRUSTED = 5
#: Training tokens for each partition of the tables.
PER_PART = 1 << 20
#: Bytes of text in a chunk, or one text if it is longer; a task holds one chunk at a time.
CHUNK_BYTES = 4 << 20
#: Bytes of text for each bucket of chunks; a bucket is one task's share when chunks meet their answers.
BUCKET_BYTES = 8 << 20

_UNKNOWN, _START, _FIRST = 0, 1, 2
_END_HASH = 0  # the end is a word of its own; no word hashes to it but by a chance of 1 in 2 ** 64
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers in few bytes: bytes of equal weight side by side, then zstd."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    kind = np.dtype(kind)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).ravel()


def discounts(seen_times: list[int]) -> np.ndarray:
    """Good-Turing factors for counts 0 to TRUSTED + 1, from how many types have counts 1 to TRUSTED + 1.

    Where those numbers give no factors between 0 and 1 (small or odd corpora), a fixed part is taken off
    each count instead: n1 / (n1 + 2 n2), or a half where there is no type seen once.
    """
    n = [0, *seen_times]
    out = np.ones(TRUSTED + 2)
    if all(n[1 : TRUSTED + 2]):
        tail = (TRUSTED + 1) * n[TRUSTED + 1] / n[1]
        for r in range(1, TRUSTED + 1):
            exact = (r + 1) * n[r + 1] / (r * n[r])
            out[r] = (exact - tail) / (1 - tail) if tail < 1 else -1
        if ((out[1 : TRUSTED + 1] > 0) & (out[1 : TRUSTED + 1] < 1)).all():
            return out
    off = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    out[1 : TRUSTED + 1] = [(r - off) / r for r in range(1, TRUSTED + 1)]
    return out


class Unigrams:
    """P(w) by the training count of w; 0 stands for all unknown words together."""

    def __init__(self, total: int, types: int, seen_times: list[int]):
        self.total, self.types = total, types
        self.factor = discounts(seen_times)
        taken = sum(r * n * (1 - self.factor[r]) for r, n in enumerate([0, *seen_times][: TRUSTED + 1]))
        # with nothing to discount, one more event makes room for the unknown
        self.events = total if taken > 0 else total + 1
        self.unknown = (taken if taken > 0 else 1) / self.events

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        factor = self.factor[np.minimum(counts, TRUSTED + 1)]
        return np.where(counts > 0, factor * counts / self.events, self.unknown)


def _read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to chunks: the words of a run of documents by number, and how often training saw each."""
    part, n = TaskContext.get().partitionId(), 0
    for batch in runs(batches, CHUNK_BYTES):
        data, starts = flat(batch.column("text"))
        codes, distinct, bounds = words(LOWER[data], starts)
        length = np.diff(bounds) + 1
        tokens = np.insert(codes.astype(np.int64), bounds[1:], len(distinct)).astype(np.uint32)
        hashes = [xxhash.xxh3_64_intdigest(word) for word in distinct.to_pylist()]
        hashes = np.array([*hashes, _END_HASH], np.uint64)
        learned = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        counts = np.bincount(tokens[np.repeat(learned, length)], minlength=len(hashes))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part << 32 | n]),
                pa.array([len(tokens)]),
                pa.array([int(np.count_nonzero(learned))]),
                pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([length.tolist()], pa.list_(pa.int64())),
                pa.array([learned.tolist()], pa.list_(pa.bool_())),
                pa.array([_pack(tokens)]),
                pa.array([_pack(hashes)]),
                pa.array([_pack(counts.astype(np.uint32))]),
            ],
            names=["chunk", "n_tokens", "n_learned", "doc_ids", "lengths", "learned", "tokens", "words", "counts"],
        )
        n += 1


_CHUNKS = """chunk long, n_tokens long, n_learned long, doc_ids array<bigint>, lengths array<bigint>,
learned array<boolean>, tokens binary, words binary, counts binary"""


def _by_part(part_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by partition, the partitions that occur, and where each begins in that order."""
    order = np.argsort(part_of, kind="stable")
    parts, begin = np.unique(part_of[order], return_index=True)
    return order, parts, np.append(begin, len(order))


def _word_part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (mix(hashes) % np.uint64(parts)).astype(np.int64)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each part, from batches that are sorted by part."""
    held: list[dict] = []
    for batch in batches:
        for row in _one_by_one(batch):
            if held and held[0]["part"] != row["part"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, of which only one at a time is copied to Python values."""
    for n in range(batch.num_rows):
        yield batch.slice(n, 1).to_pylist()[0]


def _ask_words(parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                hashes, counts = _unpack(row["words"], "<u8"), _unpack(row["counts"], "<u4")
                order, found, begin = _by_part(_word_part(hashes, parts))
                spans = [order[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found),
                        pa.array([row["chunk"]] * len(found), pa.int64()),
                        pa.array([_pack(hashes[s]) for s in spans], pa.binary()),
                        pa.array([_pack(counts[s]) for s in spans], pa.binary()),
                    ],
                    names=["part", "chunk", "words", "counts"],
                )

    return ask


def _answer_words(parts: int):
    """Adds up one part of the word table; numbers its words, frequent ones first."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            asked = [_unpack(row["words"], "<u8") for row in rows]
            counts = np.concatenate([_unpack(row["counts"], "<u4") for row in rows])
            distinct, place = np.unique(np.concatenate(asked), return_inverse=True)
            total = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)
            number = np.empty(len(distinct), np.int64)
            number[np.argsort(-total, kind="stable")] = np.arange(len(distinct))
            number = np.where(total > 0, number * parts + rows[0]["part"] + _FIRST, _UNKNOWN)
            if len(number) and number.max() >= 1 << 32:
                raise ValueError("more words than numbers of 32 bits")
            ends = np.cumsum([0, *map(len, asked)])
            spans = [place[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            stats = [int(total.sum()), int(np.count_nonzero(total))]
            stats += [int(np.count_nonzero(total == r)) for r in range(1, TRUSTED + 2)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["chunk"] for row in rows], pa.int64()),
                    pa.array([row["part"] for row in rows], pa.int64()),
                    pa.array([_pack(number[s].astype(np.uint32)) for s in spans], pa.binary()),
                    pa.array([_pack(total[s]) for s in spans], pa.binary()),
                    pa.array([stats, *[None] * (len(rows) - 1)], pa.list_(pa.int64())),
                ],
                names=["chunk", "part", "numbers", "totals", "stats"],
            )

    return answer


class _Chunk:
    """A chunk with what the word table answered: its tokens, and the bigrams to ask for."""

    def __init__(self, row: dict, parts: int, learned_docs: int, per_part: int):
        tokens, hashes = _unpack(row["tokens"], "<u4"), _unpack(row["words"], "<u8")
        order, _, _ = _by_part(_word_part(hashes, parts))
        answers = sorted(row["answers"], key=lambda one: one["part"])
        number, total = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
        number[order] = np.concatenate([_unpack(one["numbers"], "<u4") for one in answers])
        total[order] = np.concatenate([_unpack(one["totals"], "<i8") for one in answers])
        self.lengths = np.array(row["lengths"], np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.word, self.count = number[tokens].astype(np.uint64), total[tokens]
        before, frequency = np.empty_like(self.word), np.empty_like(self.count)
        before[1:], frequency[1:] = self.word[:-1], self.count[:-1]
        before[self.first], frequency[self.first] = _START, learned_docs
        # after an unknown word there is nothing to look up
        self.asked = np.flatnonzero(before != _UNKNOWN)
        pair = before[self.asked] << np.uint64(32) | self.word[self.asked]
        distinct, one, place = np.unique(pair, return_index=True, return_inverse=True)
        learned = np.repeat(np.array(row["learned"], bool), self.lengths)[self.asked]
        times = np.bincount(place, weights=learned, minlength=len(distinct)).astype(np.int64)
        context = distinct >> np.uint64(32)
        spread = 1 + frequency[self.asked][one] // per_part
        home = mix(context)
        share = mix(distinct ^ _SPREAD) % spread.astype(np.uint64)
        part = ((home + share) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((distinct, part))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.place = back[place]
        self.part, self.pair, self.times = part[order], distinct[order], times[order]
        self.pair_count = self.count[self.asked][one][order]
        self.wide = (spread > 1)[order]
        #: where a new context begins, in the order of the questions
        context = self.pair >> np.uint64(32)
        self.turn = np.flatnonzero(
            np.concatenate([[True], (context[1:] != context[:-1]) | (self.part[1:] != self.part[:-1])])
        ) if len(context) else np.zeros(0, np.int64)
        self.context = context


def _ask_pairs(parts: int, learned_docs: int, per_part: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                chunk = _Chunk(row, parts, learned_docs, per_part)
                if not len(chunk.pair):
                    continue
                found, begin = np.unique(chunk.part, return_index=True)
                spans = [slice(a, b) for a, b in zip(begin, [*begin[1:], len(chunk.part)], strict=True)]
                context = chunk.context.astype(np.uint32)
                steps = [np.diff(context[s], prepend=np.uint32(0)) for s in spans]
                wide = [np.unique(context[s][chunk.wide[s]]).tolist() for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found),
                        pa.array([row["chunk"]] * len(found), pa.int64()),
                        pa.array([_pack(s) for s in steps], pa.binary()),
                        pa.array([_pack(chunk.pair[s].astype(np.uint32)) for s in spans], pa.binary()),
                        pa.array([_pack(chunk.times[s].astype(np.uint32)) for s in spans], pa.binary()),
                        pa.array([_pack(chunk.pair_count[s]) for s in spans], pa.binary()),
                        pa.array(wide, pa.list_(pa.int64())),
                    ],
                    names=["part", "chunk", "contexts", "words", "times", "counts", "wide"],
                )

    return ask


_PAIRS = """part long, chunk long, contexts binary, words binary, times binary, counts binary,
wide array<bigint>"""


def _answer_pairs(unigrams: Unigrams):
    """Adds up one part of the bigram table and says what each context's backoff weight needs."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            asked, times, counts = [], [], []
            for row in rows:
                context = np.cumsum(_unpack(row["contexts"], "<u4"), dtype=np.uint64)
                context &= np.uint64(0xFFFFFFFF)
                asked.append(context << np.uint64(32) | _unpack(row["words"], "<u4"))
                times.append(_unpack(row["times"], "<u4"))
                counts.append(_unpack(row["counts"], "<i8"))
            pair, one, place = np.unique(
                np.concatenate(asked), return_index=True, return_inverse=True
            )
            total = np.bincount(place, weights=np.concatenate(times), minlength=len(pair)).astype(np.int64)
            lower = np.where(total > 0, unigrams(np.concatenate(counts)[one]), 0.0)
            context = pair >> np.uint64(32)
            names, begin, of_pair = np.unique(context, return_index=True, return_inverse=True)
            events = np.add.reduceat(total, begin)
            rare = np.stack([np.add.reduceat((total == r).astype(np.int64), begin) for r in range(1, TRUSTED + 1)])
            known = np.add.reduceat(lower, begin)
            ends = np.cumsum([0, *map(len, asked)])
            out = []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                own = of_pair[place[a:b]]
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
                out.append(
                    (
                        _pack(total[place[a:b]].astype(np.uint32)),
                        _pack(events[own]),
                        _pack(np.ascontiguousarray(rare[:, own].ravel().astype(np.uint32))),
                        _pack(known[own]),
                    )
                )
            wide = sorted({n for row in rows for n in row["wide"]})
            at = np.searchsorted(names, np.array(wide, np.uint64))
            sums = [
                {"context": n, "events": int(events[i]), "rare": rare[:, i].tolist(), "known": float(known[i])}
                for n, i in zip(wide, at, strict=True)
            ]
            stats = [int(np.count_nonzero(total == r)) for r in range(1, TRUSTED + 2)]
            empty = [None] * (len(rows) - 1)
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "chunk": row["chunk"],
                        "part": row["part"],
                        "totals": packed[0],
                        "events": packed[1],
                        "rare": packed[2],
                        "known": packed[3],
                        "stats": own_stats,
                        "sums": own_sums,
                    }
                    for row, packed, own_stats, own_sums in zip(
                        rows, out, [stats, *empty], [sums, *empty], strict=True
                    )
                ],
                schema=_ANSWERS_ARROW,
            )

    return answer


_SUM_FIELDS = pa.struct(
    [
        ("context", pa.int64()),
        ("events", pa.int64()),
        ("rare", pa.list_(pa.int64())),
        ("known", pa.float64()),
    ]
)
_ANSWERS_ARROW = pa.schema(
    [
        ("chunk", pa.int64()),
        ("part", pa.int64()),
        ("totals", pa.binary()),
        ("events", pa.binary()),
        ("rare", pa.binary()),
        ("known", pa.binary()),
        ("stats", pa.list_(pa.int64())),
        ("sums", pa.list_(_SUM_FIELDS)),
    ]
)
_ANSWERS = """chunk long, part long, totals binary, events binary, rare binary, known binary,
stats array<bigint>, sums array<struct<context:bigint,events:bigint,rare:array<bigint>,known:double>>"""


def backoff(events, rare, known, factor: np.ndarray):
    """Per context: what its counts are divided by, and its backoff weight.

    ``rare`` has a row for each count up to TRUSTED: how many words were seen that often. ``known`` is the
    sum of P(w) over all words that were seen. With no count to discount, one more event makes room.
    """
    off = np.array([r * (1 - factor[r]) for r in range(1, TRUSTED + 1)])
    free = off @ rare
    room = free > 0
    divisor = np.where(room, events, events + 1).astype(float)
    weight = np.where(room, free, 1.0) / divisor / (1 - known)
    return divisor, np.where(events > 0, weight, 1.0)


def _score(parts: int, learned_docs: int, per_part: int, unigrams: Unigrams, pair_factor: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = unigrams.total + 0.1 * (unigrams.types + 1)
        for batch in batches:
            for row in _one_by_one(batch):
                chunk = _Chunk(row, parts, learned_docs, per_part)
                value = np.log10(unigrams(chunk.count))
                if len(chunk.pair):
                    answers = sorted(row["pair_answers"], key=lambda one: one["part"])

                    def joined(name: str, kind: str, answers=answers) -> np.ndarray:
                        return np.concatenate([_unpack(one[name], kind) for one in answers])

                    total = joined("totals", "<u4").astype(np.int64)
                    events, known = joined("events", "<i8"), joined("known", "<f8")
                    rare = np.concatenate(
                        [_unpack(one["rare"], "<u4").reshape(TRUSTED, -1) for one in answers], axis=1
                    ).astype(np.int64)
                    context = chunk.context[chunk.turn].astype(np.int64)
                    for sums in row["wide_sums"] or []:
                        at = np.flatnonzero(context == sums["context"])
                        events[at], known[at] = sums["events"], sums["known"]
                        rare[:, at] = np.array(sums["rare"])[:, None]
                    divisor, weight = backoff(events, rare, known, pair_factor)
                    of_pair = np.repeat(
                        np.arange(len(chunk.turn)), np.diff(np.append(chunk.turn, len(chunk.pair)))
                    )
                    seen = pair_factor[np.minimum(total, TRUSTED + 1)] * total / divisor[of_pair]
                    back = weight[of_pair] * unigrams(chunk.pair_count)
                    value[chunk.asked] = np.log10(np.where(total > 0, seen, back))[chunk.place]
                base = np.log10((chunk.count + 0.1) / floor)
                first = chunk.first
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([not one for one in row["learned"]], pa.bool_()),
                        pa.array(chunk.lengths),
                        pa.array(np.add.reduceat((chunk.count > 0).astype(np.int64), first)),
                        pa.array(np.full(len(first), unigrams.total)),
                        pa.array(np.add.reduceat(base, first)),
                        pa.array(np.add.reduceat(value, first)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return score


_SCORES = """doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,
base_score double, score double"""


def _buckets(docs: DataFrame) -> int:
    """As many buckets of chunks as the texts fill, up to the number that the session allows."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    allowed = int(docs.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(max(1, -(-size // BUCKET_BYTES)), allowed)


def _per_chunk(rows: DataFrame, columns: list[str], name: str, buckets: int) -> DataFrame:
    """A chunk's answers in one row, where the chunk's bucket is; their size is bounded by that of the chunk."""
    return rows.repartition(buckets, "chunk").groupBy("chunk").agg(F.collect_list(F.struct(*columns)).alias(name))


def score(docs: DataFrame, held_out: Column, per_part: int = PER_PART) -> DataFrame:
    """Log10 probability of each text under a model of the rows for which ``held_out`` is false.

    Columns: doc_id, held_out, n_tokens (words and one end), n_known, train_tokens, base_score (the
    additive unigram score) and score. Words are separated by ASCII white space, A-Z count as a-z. A
    NULL text counts as empty and is its end alone; repeated rows count and are scored each. Without any
    training row every word is unknown and has probability 1. An empty table gives an empty result. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "katz")
    buckets = _buckets(docs)
    table = f"katz_{uuid.uuid4().hex}"
    # chunks lie in buckets, so that answers come to them and they never move
    docs.select("doc_id", "text", F.coalesce(held_out, F.lit(True)).alias("held_out")).mapInArrow(
        _read_chunks, _CHUNKS
    ).write.option("path", scratch.path("chunks")).option("compression", "uncompressed").bucketBy(
        buckets, "chunk"
    ).sortBy("chunk").saveAsTable(table)
    try:
        return _scored(spark.table(table), scratch, buckets, per_part)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        scratch.drop("chunks")


def _scored(chunks: DataFrame, scratch: Scratch, buckets: int, per_part: int) -> DataFrame:
    """Learns from the chunks and scores them; the scores are written, so that the chunks can go."""
    size = chunks.agg(F.sum("n_tokens"), F.sum("n_learned")).first()
    if size[0] is None:
        return chunks.sparkSession.createDataFrame([], _SCORES)
    parts, learned_docs = max(1, -(-size[0] // per_part)), int(size[1])

    asked = chunks.select("chunk", "words", "counts").mapInArrow(
        _ask_words(parts), "part long, chunk long, words binary, counts binary"
    )
    word_table = scratch.write(
        asked.repartition("part").sortWithinPartitions("part").mapInArrow(
            _answer_words(parts),
            "chunk long, part long, numbers binary, totals binary, stats array<bigint>",
        ),
        "words",
    )
    sums = word_table.agg(
        *[F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(TRUSTED + 3)]
    ).first()
    unigrams = Unigrams(sums[0], sums[1], [int(n) for n in sums[2:]])

    numbered = chunks.join(_per_chunk(word_table, ["part", "numbers", "totals"], "answers", buckets), "chunk")
    pairs = numbered.select(
        "chunk", "tokens", "words", "lengths", "learned", "answers"
    ).mapInArrow(_ask_pairs(parts, learned_docs, per_part), _PAIRS)
    bigrams = scratch.write(
        pairs.repartition("part").sortWithinPartitions("part").mapInArrow(_answer_pairs(unigrams), _ANSWERS),
        "bigrams",
    )
    times = bigrams.agg(
        *[F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(TRUSTED + 1)]
    ).first()
    factor = discounts([int(n or 0) for n in times])

    answers = _per_chunk(bigrams, ["part", "totals", "events", "rare", "known"], "pair_answers", buckets)
    ready = numbered.join(answers, "chunk", "left")
    wide = bigrams.select(F.explode("sums").alias("one")).groupBy("one.context").agg(
        F.sum("one.events").alias("events"),
        F.array(*[F.sum(F.get("one.rare", F.lit(i))) for i in range(TRUSTED)]).alias("rare"),
        F.sum("one.known").alias("known"),
    )
    asking = bigrams.select("chunk", "part").distinct()
    held = bigrams.where("sums IS NOT NULL").select("part", F.explode("sums.context").alias("context"))
    wide_sums = _per_chunk(
        asking.join(held, "part").select("chunk", "context").distinct().join(wide, "context"),
        ["context", "events", "rare", "known"],
        "wide_sums",
        buckets,
    )
    ready = ready.join(wide_sums, "chunk", "left")
    scored = ready.select(
        "doc_ids", "tokens", "words", "lengths", "learned", "answers", "pair_answers", "wide_sums"
    ).mapInArrow(_score(parts, learned_docs, per_part, unigrams, factor), _SCORES)
    scores = scratch.write(scored, "scores")
    for done in ("words", "bigrams"):
        scratch.drop(done)
    return scores
