"""Language identification by the nearest of several centroids per language.

A text becomes a unit vector: counts of hashed letter n-grams, damped by the logarithm, weighted by
inverse document frequency. Each language's labelled vectors are clustered by spherical k-means, and a text
gets the language of the centroid with the largest cosine. The distances also say how sure that is: a
text much farther from every centroid than labelled texts of its length is rejected, and one that is
rather far is when its second language is nearly as close as its first. Noise in a text of a learned
language takes from both cosines alike; a language that was not learned is about as far from several.

The model is fitted on a bounded sample, ``PER_LANGUAGE`` labelled texts of each language with the
smallest hashes of their ids; everything is predicted. Each language is clustered in a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlens.llm.arrowtext import flat, runs
from ticketlens.llm.scratch import Scratch
from ticketlens.llm.shipping import ship
from ticketlens.llm.token_ids import KINDS, kinds_of, lowered

#: Labelled texts per language that the model is fitted on, and languages at most.
PER_LANGUAGE = 500
MAX_LANGUAGES = 200

ORDERS = (1, 2, 3)
BUCKETS = 1 << 13
CENTROIDS = 4
ROUNDS = 10
#: A text is rejected when its cosine is below this share of what labelled texts of its length reach.
REJECT = 0.2
#: Below this share it is rejected as well when its second language comes as near to the first as MARGIN.
DOUBT = 0.5
MARGIN = 0.78
#: Ranking the sample is spread over so many tasks a language.
_SPREAD = 64

UNKNOWN = "und"
_TEXTS = 256
_LETTER, _WIDE = int(KINDS[97]), int(KINDS[255])


def counts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashed n-gram counts, a row per text. Case is folded; what is no letter counts as space."""
    n = len(starts) - 1
    low = lowered(data)
    kinds = kinds_of(data)
    code = np.where((kinds == _LETTER) | (kinds == _WIDE), low, np.uint8(32)).astype(np.uint32)
    row = np.repeat(np.arange(n, dtype=np.int64) * BUCKETS, starts[1:] - starts[:-1])
    until = np.repeat(starts[1:], starts[1:] - starts[:-1])
    found = np.zeros(n * BUCKETS, np.float32)
    gram = np.zeros(len(code), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        size = len(code) - order + 1
        if size <= 0:
            break
        gram = (gram[:size] << np.uint32(8)) | code[order - 1 :]
        if order not in ORDERS:
            continue
        inside = np.arange(order, size + order) <= until[:size]
        # n-grams of nothing but spaces say nothing
        inside &= gram != np.uint32(0x20202020 >> (8 * (4 - order)))
        slot = ((gram + np.uint32(order << 28)) * np.uint32(2654435761)) >> np.uint32(32 - 13)
        found += np.bincount((row[:size] + slot)[inside], minlength=n * BUCKETS)
    return found.reshape(n, BUCKETS)


def _length_class(found: np.ndarray) -> np.ndarray:
    return np.log2(1 + found.sum(axis=1)).astype(int)


@dataclass
class Model:
    """Languages, their weights and centroids, and the usual cosine by length of the text."""

    languages: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None
    centroids: np.ndarray | None = None
    owner: np.ndarray | None = None
    usual: np.ndarray | None = None

    def vectors(self, found: np.ndarray) -> np.ndarray:
        """Unit vectors of the counts, in the place of the counts."""
        np.log1p(found, out=found)
        found *= self.weights
        norm = np.linalg.norm(found, axis=1, keepdims=True)
        found /= np.where(norm > 0, norm, 1)
        return found

    def predict(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the language, cosine, and whether the text is rejected."""
        length = np.minimum(_length_class(found), len(self.usual) - 1)
        near = self.vectors(found) @ self.centroids.T
        # a language's centroids lie side by side
        first = np.flatnonzero(np.diff(self.owner, prepend=-1))
        near = np.maximum.reduceat(near, first, axis=1)
        best = near.argmax(axis=1)
        score = np.clip(near[np.arange(len(near)), best], 0, 1)
        usual = self.usual[length]
        rejected = score < REJECT * usual
        if len(first) > 1:
            second = np.partition(near, -2, axis=1)[:, -2]
            rejected |= (score < DOUBT * usual) & (second > MARGIN * score)
        return self.owner[first][best], score, rejected


def _cluster(vectors: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids by spherical k-means, seeded by the farthest vectors."""
    centers = [vectors.mean(axis=0)]
    near = np.full(len(vectors), -1.0)
    for _ in range(min(k, len(vectors)) - 1):
        near = np.maximum(near, vectors @ centers[-1])
        centers.append(vectors[int(near.argmin())])
    centers = np.array(centers)
    for _ in range(ROUNDS):
        owner = (vectors @ centers.T).argmax(axis=1)
        for c in range(len(centers)):
            if (owner == c).any():
                centers[c] = vectors[owner == c].mean(axis=0)
        norm = np.linalg.norm(centers, axis=1, keepdims=True)
        centers = centers / np.where(norm > 0, norm, 1)
    return centers


def sample(docs: DataFrame, labelled: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The bounded sample: lang and text of labelled rows, by the smallest hashes of their ids.

    An id counts once a language, with the text of the smallest hash, however often it is repeated. At most
    ``MAX_LANGUAGES`` languages are taken, those with the most sampled ids.
    """
    chosen = docs.where(labelled & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    chosen = chosen.select("doc_id", "lang", "text")
    ids = chosen.select("doc_id", "lang").distinct().withColumn("place", F.xxhash64("doc_id"))
    # the smallest of each share of a language's ids, then the smallest of those
    share = F.pmod(F.xxhash64("place"), F.lit(_SPREAD))
    for keys in (["lang", share], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("place", "doc_id")
        ids = ids.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language)
    largest = ids.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    kept = largest.limit(MAX_LANGUAGES).select("lang")
    ids = ids.join(F.broadcast(kept), "lang").select("doc_id", "lang")
    # the number of ids is bounded by the two parameters above
    rows = chosen.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi")
    return rows.groupBy("doc_id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def _sparse(rows: DataFrame) -> DataFrame:
    """Per row with a text: lang, the slots of its n-grams that occur, and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            for at in range(0, batch.num_rows, _TEXTS):
                some = batch.slice(at, _TEXTS)
                found = counts(*flat(some.column("text")))
                slots = [np.flatnonzero(row) for row in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("lang"),
                        pa.array([s.astype("<u2").tobytes() for s in slots], pa.binary()),
                        pa.array(
                            [row[s].astype("<f4").tobytes() for row, s in zip(found, slots, strict=True)],
                            pa.binary(),
                        ),
                    ],
                    names=["lang", "slots", "counts"],
                )

    return rows.mapInArrow(count, "lang string, slots binary, counts binary").where("length(slots) > 0")


def _held(rows: DataFrame) -> tuple[int, np.ndarray]:
    """How many rows there are, and in how many of them each n-gram slot occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for slots in batch.column("slots"):
                held[np.frombuffer(slots.as_buffer(), "<u2")] += 1
            held[BUCKETS] += batch.num_rows
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(held[found])], names=["slot", "n"])

    sums = rows.select("slots").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n"))
    held = np.zeros(BUCKETS + 1, np.int64)
    for slot, n in sums.collect():
        held[slot] = n
    return int(held[BUCKETS]), held[:BUCKETS]


def fit(docs: DataFrame, labelled: Column, per_language: int = PER_LANGUAGE) -> Model:
    """The model of a bounded sample of the rows for which ``labelled`` is true.

    The driver receives a count per n-gram slot, and of each language its centroids and a length and a
    cosine for every sampled text. Without any labelled text that has n-grams the model knows no language.
    """
    scratch = Scratch(docs.sparkSession, "language")
    rows = scratch.write(_sparse(sample(docs, labelled, per_language).select("lang", "text")), "sample")
    n_rows, held = _held(rows)
    if not n_rows:
        scratch.drop("sample")
        return Model()
    weights = (np.log((1 + n_rows) / (1 + held)) + 1).astype(np.float32)

    def cluster(table: pa.Table) -> pa.Table:
        texts = sorted(zip(table.column("slots").to_pylist(), table.column("counts").to_pylist(), strict=True))
        found = np.zeros((len(texts), BUCKETS), np.float32)
        for n, (slots, values) in enumerate(texts):
            found[n, np.frombuffer(slots, "<u2")] = np.frombuffer(values, "<f4")
        length = _length_class(found)
        vectors = Model(weights=weights).vectors(found)
        centers = _cluster(vectors, CENTROIDS).astype("<f4")
        best = (vectors @ centers.T).max(axis=1)
        return pa.table(
            {
                "lang": table.column("lang")[:1],
                "centroids": pa.array([centers.tobytes()], pa.binary()),
                "length": pa.array([length.tolist()], pa.list_(pa.int64())),
                "best": pa.array([best.tolist()], pa.list_(pa.float64())),
            }
        )

    schema = "lang string, centroids binary, length array<bigint>, best array<double>"
    parts = sorted(rows.groupBy("lang").applyInArrow(cluster, schema).collect(), key=lambda r: r["lang"])
    scratch.drop("sample")
    model = Model([part["lang"] for part in parts], weights)
    centers = [np.frombuffer(part["centroids"], "<f4").reshape(-1, BUCKETS) for part in parts]
    model.centroids = np.concatenate(centers)
    model.owner = np.repeat(np.arange(len(parts)), [len(part) for part in centers])
    length = np.concatenate([part["length"] for part in parts])
    best = np.concatenate([part["best"] for part in parts])
    model.usual = np.zeros(int(length.max()) + 1, np.float32)
    # short texts reach less; a class without enough texts takes what shorter ones reach
    least = 0.0
    for n in range(len(model.usual)):
        own = best[length == n]
        if len(own) >= 20:
            least = float(np.quantile(own, 0.05))
        model.usual[n] = least
    return model


def _has_letter(column: pa.Array, found: np.ndarray) -> np.ndarray:
    data, starts = flat(column)
    kinds = kinds_of(data)
    plain = np.concatenate([[0], np.cumsum(kinds == _LETTER)])
    letter = plain[starts[1:]] > plain[starts[:-1]]
    wide = np.concatenate([[0], np.cumsum(kinds == _WIDE)])
    for row in np.flatnonzero(~letter & (wide[starts[1:]] > wide[starts[:-1]])):
        letter[row] = any(c.isalpha() for c in column[int(row)].as_py())
    return letter


def predict(
    docs: DataFrame,
    model: Model,
    keep: tuple[str, ...] = ("doc_id",),
    names: tuple[str, str, str] = ("lang_pred", "score", "rejected"),
) -> DataFrame:
    """The columns ``keep`` of each row with lang_pred, score and rejected, under those ``names``.

    A NULL text, and one without any letter, gives ``und``, score 0 and is rejected; so does every
    text when nothing was labelled. Repeated rows get a prediction each, an empty table none. All of a text
    is counted, however long it is. Other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(*keep, *([] if "text" in keep else ["text"]))
    kept = [rows.schema[name] for name in keep]
    schema = T.StructType(kept)
    for name, kind in zip(names, ("string", "double", "boolean"), strict=True):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            for at in range(0, batch.num_rows, _TEXTS):
                some = batch.slice(at, _TEXTS)
                text = some.column("text")
                found = counts(*flat(text))
                known = _has_letter(text, found)
                lang = np.full(len(text), UNKNOWN, object)
                score, rejected = np.zeros(len(text)), np.ones(len(text), bool)
                if model.languages:
                    best, near, far = model.predict(found)
                    lang[known] = np.array(model.languages, object)[best[known]]
                    score[known], rejected[known] = near[known], far[known]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[some.column(name) for name in keep],
                        pa.array(lang, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(rejected, pa.bool_()),
                    ],
                    names=[*keep, *names],
                )

    return rows.mapInArrow(run, schema)


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language the model knows, with all their columns."""
    names = ("__lang", "__score", "__rejected")
    found = predict(docs, model, tuple(docs.columns), names)
    return found.where("NOT __rejected").select(*docs.columns)


def held_out(doc_id: Column, folds: int) -> Column:
    """Whether the row belongs to the fold that no model learns from; a NULL id does."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % folds
    return F.coalesce(fold == 0, F.lit(True))
