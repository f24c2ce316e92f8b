"""Language identification and the language model against held-out rows and plain Python."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import SMALL, documents, empty, in_fold, lower, rows, words
from pyspark.sql import functions as F

from ticketlens.llm import katz_lm, language_id

LARGER = "/root/testdata/sf0.01"


def test_held_out_rows_get_their_language(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = language_id.held_out(F.col("doc_id"), 5)
    found = language_id.predict(docs, language_id.fit(docs, ~held)).join(docs, "doc_id").withColumn("held", held)
    seen = [r for r in found.collect() if r["held"]]
    assert len(seen) > 20
    assert sum(r["lang_pred"] == r["lang"] for r in seen) >= 0.97 * len(seen)
    assert not any(r["rejected"] for r in seen)


def test_predictions_of_odd_rows(spark):
    docs = documents(spark)
    held = language_id.held_out(F.col("doc_id"), 5)
    model = language_id.fit(docs, ~held)
    found = language_id.predict(docs, model).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _, _ in rows())
    letters = {(i, any(c.isalpha() for c in t or "")) for i, t, _ in rows()}
    for r in found:
        assert 0 <= r["score"] <= 1
        assert r["lang_pred"] in {*model.languages, "und"}
        assert (r["doc_id"], r["lang_pred"] != "und") in letters
    assert language_id.predict(empty(spark), model).count() == 0
    assert language_id.keep_known(docs, model).columns == docs.columns


def test_foreign_texts_are_rejected_and_nothing_is_known_without_labels(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.fit(docs, F.lit(True))
    odd = spark.createDataFrame(
        [(1, "Съешь ещё этих мягких французских булок да выпей чаю " * 20), (2, "0000 11 !!")],
        "doc_id long, text string",
    )
    assert all(r["rejected"] for r in language_id.predict(odd, model).collect())
    none = language_id.fit(docs, F.lit(False))
    assert {r["lang_pred"] for r in language_id.predict(docs.limit(5), none).collect()} == {"und"}


FOREIGN = [
    "Il sole era appena sorto quando la nave lasciò il porto e i marinai cantavano una vecchia canzone che "
    "nessuno ricordava più. La città rimaneva silenziosa dietro le colline, mentre il vento portava il profumo del pane.",
    "De zon was net opgekomen toen het schip de haven verliet en de matrozen een oud lied zongen dat niemand "
    "zich meer herinnerde. De stad bleef stil achter de heuvels liggen terwijl de wind de geur van brood bracht.",
    "Słońce właśnie wzeszło, gdy statek opuścił port, a marynarze śpiewali starą pieśń, której nikt już nie "
    "pamiętał. Miasto pozostawało ciche za wzgórzami, a wiatr niósł zapach świeżego chleba.",
]
LEARNED = [
    "The sun had only just risen when the ship left the harbour and the sailors sang an old song that nobody "
    "remembered any more. The town stayed silent behind the hills while the wind carried the smell of bread.",
    "Die Sonne war gerade aufgegangen, als das Schiff den Hafen verließ und die Matrosen ein altes Lied sangen, "
    "an das sich niemand mehr erinnerte. Die Stadt blieb still hinter den Hügeln liegen.",
]


def test_unlearned_latin_languages_are_rejected_and_unusual_texts_of_learned_ones_are_not(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = language_id.fit(docs, F.lit(True))
    made = [(n, text) for n, text in enumerate([*FOREIGN, *LEARNED])]
    found = language_id.predict(spark.createDataFrame(made, "doc_id long, text string"), model).collect()
    verdict = [r["rejected"] for r in sorted(found, key=lambda r: r["doc_id"])]
    assert verdict == [True] * len(FOREIGN) + [False] * len(LEARNED)


@pytest.mark.parametrize("left_out", ["de", "en", "fr"])
def test_a_language_left_out_is_rejected(spark, left_out):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = language_id.fit(docs, F.col("lang") != left_out)
    assert left_out not in model.languages
    found = language_id.predict(docs, model, ("doc_id", "lang", "text")).where("length(text) > 300").collect()
    foreign = [r["rejected"] for r in found if r["lang"] == left_out]
    own = [r["rejected"] for r in found if r["lang"] in model.languages]
    assert sum(foreign) >= 0.7 * len(foreign) > 20
    assert sum(own) <= 0.01 * len(own)


def test_predictions_equal_a_plain_nearest_centroid(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    model = language_id.fit(docs, F.lit(True))
    found = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    for row in docs.collect():
        grams = Counter()
        letters = "".join(c.lower() if c.isascii() and c.isalpha() or not c.isascii() else " " for c in row["text"])
        code = lower(letters).encode()
        for order in language_id.ORDERS:
            for at in range(len(code) - order + 1):
                gram = code[at : at + order]
                if gram.strip(b" "):
                    number = int.from_bytes(gram) + (order << 28)
                    grams[(number * 2654435761 % 2**32) >> 19] += 1
        vector = {k: math.log1p(n) * float(model.weights[k]) for k, n in grams.items()}
        norm = math.sqrt(sum(x * x for x in vector.values()))
        near = [sum(x * float(c[k]) for k, x in vector.items()) / norm for c in model.centroids]
        best = max(range(len(near)), key=near.__getitem__)
        assert found[row["doc_id"]]["lang_pred"] == model.languages[model.owner[best]]
        assert math.isclose(found[row["doc_id"]]["score"], near[best], abs_tol=1e-4)


def test_the_sample_is_bounded(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"))
    assert language_id.sample(docs, F.lit(True), per_language=30).count() == 30
    one = spark.range(5000).select(F.lit(1).alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit("en").alias("lang"))
    assert language_id.sample(one, F.lit(True), per_language=30).count() == 1
    both = docs.unionByName(one.withColumn("lang", F.lit("de")))
    found = language_id.sample(both.repartition(7), F.lit(True), per_language=30).groupBy("lang").count().collect()
    assert {tuple(r) for r in found} == {("en", 30), ("de", 1)}


class Katz:
    """The same model by dictionaries."""

    def __init__(self, texts):
        tokens = [[*words(lower(t or "")), None] for t in texts]
        self.one, self.two = Counter(), defaultdict(Counter)
        for found in tokens:
            self.one.update(found)
            for h, w in zip([0, *found[:-1]], found, strict=True):
                self.two[h][w] += 1
        top = katz_lm.TRUSTED

        def times(counts):
            return [sum(c == r for c in counts) for r in range(1, top + 2)]

        self.n = sum(self.one.values())
        d1 = katz_lm.discounts(times(self.one.values()))
        d2 = katz_lm.discounts(times([c for m in self.two.values() for c in m.values()]))
        free = sum(c * (1 - d1[c]) for c in self.one.values() if c <= top)
        events = self.n if free > 0 else self.n + 1
        self.unknown = (free if free > 0 else 1) / events
        self.p1 = {w: d1[min(c, top + 1)] * c / events for w, c in self.one.items()}
        self.p2, self.alpha = {}, {}
        for h, seen in self.two.items():
            free = sum(c * (1 - d2[c]) for c in seen.values() if c <= top)
            events = sum(seen.values()) + (free <= 0)
            self.p2[h] = {w: d2[min(c, top + 1)] * c / events for w, c in seen.items()}
            self.alpha[h] = (free if free > 0 else 1) / events / (1 - sum(self.p1[w] for w in seen))

    def p(self, h, w):
        lower_p = self.p1.get(w, self.unknown)
        if h not in self.p2:
            return lower_p
        return self.p2[h].get(w, self.alpha[h] * lower_p)

    def score(self, text):
        found = [*words(lower(text or "")), None]
        return sum(math.log10(self.p(h, w)) for h, w in zip([0, *found[:-1]], found, strict=True))


def check(found, made, model):
    wanted = Counter()
    for doc_id, text in made:
        tokens = [*words(lower(text or "")), None]
        base = sum(
            math.log10((model.one.get(w, 0) + 0.1) / (model.n + 0.1 * (len(model.one) + 1))) for w in tokens
        )
        known = sum(w in model.one for w in tokens)
        wanted[doc_id, in_fold(doc_id, 10), len(tokens), known, round(base, 5), round(model.score(text), 5)] += 1
    got = Counter(
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 5), round(r["score"], 5))
        for r in found
    )
    assert got == wanted
    assert {r["train_tokens"] for r in found} == {model.n}


@pytest.mark.parametrize("per_part", [katz_lm.PER_PART, 500])
def test_scores_of_odd_rows(spark, per_part):
    made = [(i, t) for i, t, _ in rows()]
    model = Katz([t for i, t in made if not in_fold(i, 10)])
    held = language_id.held_out(F.col("doc_id"), 10)
    check(katz_lm.score(documents(spark).repartition(4), held, per_part).collect(), made, model)


def test_probabilities_after_each_word_add_up_to_one():
    model = Katz([t for _, t, _ in rows(30)])
    assert math.isclose(sum(model.p1.values()) + model.unknown, 1)
    for h in [*list(model.p2)[:200], "never seen"]:
        total = sum(model.p(h, w) for w in model.one) + model.p(h, "never seen")
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_frequent_words_only_still_leave_room_for_others(spark):
    made = [(n, "a a a a a a a a") for n in range(1, 40)] + [(100, "b a c"), (101, None)]
    model = Katz([t for i, t in made if not in_fold(i, 10)])
    docs = spark.createDataFrame(made, "doc_id long, text string")
    found = katz_lm.score(docs, language_id.held_out(F.col("doc_id"), 10)).collect()
    check(found, made, model)
    assert all(np.isfinite(r["score"]) for r in found)


def test_no_training_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = katz_lm.score(docs, F.lit(True)).collect()
    assert {(r["doc_id"], r["n_known"], r["score"]) for r in found} == {(1, 0, 0.0), (2, 0, 0.0)}
    assert katz_lm.score(empty(spark), F.lit(False)).count() == 0


def test_buckets_follow_the_input_and_the_table_goes(spark, monkeypatch):
    made = [(i, t) for i, t, _ in rows()]
    texts = spark.createDataFrame(made, "doc_id long, text string")
    size = sum(len((t or "").encode()) for _, t in made)
    monkeypatch.setattr(katz_lm, "BUCKET_BYTES", size // 5)
    assert katz_lm._buckets(texts) in (5, 6) and katz_lm._buckets(texts.limit(0)) == 1
    held = language_id.held_out(F.col("doc_id"), 10)
    check(katz_lm.score(texts.repartition(7), held, 500).collect(), made, Katz([t for i, t in made if not in_fold(i, 10)]))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("katz_")]


def test_discounts_fall_back_on_odd_counts():
    assert katz_lm.discounts([0, 0, 0, 0, 0, 0])[1:6].tolist() == [(r - 0.5) / r for r in range(1, 6)]
    for times in ([100, 40, 20, 12, 8, 5], [5, 9, 1, 0, 3, 2], [3, 3, 3, 3, 3, 3]):
        found = katz_lm.discounts(times)
        assert ((found[1:6] > 0) & (found[1:6] < 1)).all() and found[6] == 1
