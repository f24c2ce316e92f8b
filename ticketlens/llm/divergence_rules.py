r"""Quality rules: repetition counts, and divergence from what a language looks like.

Each text gives two histograms: its characters by class, and its words by a list of common words
per language. They are compared with references, which are the summed histograms of all texts of a
language, by the Jensen-Shannon distance (base 2, from 0 to 1). A text fails when it is far from
every language. Short texts are guarded: below a minimum length a histogram says nothing and is
not compared. How far is too far for words follows from the reference texts of about the same length:
the upper quartile of their distances and a multiple of what lies between it and the median. Words of a
text whose own language has no reference are not compared, as no list says what they should be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.scratch import Scratch

WHITE = r"[\x20\x09-\x0D]+"
WINDOW = 8

#: Common words of the languages that texts are held against.
COMMON = {
    "de": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als",
    "en": "the of and to a in is that it for was on with as be this by at are from",
    "es": "de la que el en y los se del las un por con no una para su es al lo",
    "fr": "de la le et les des en un du une que est pour qui dans au sur par pas avec",
}
#: Characters by class; the rest, mostly small letters, is a class of its own.
CLASSES = {
    "capital": r"[A-Z]",
    "digit": r"[0-9]",
    "mark": r"""[.,;:!?'"()-]""",
    "symbol": r"[#*$%&|<>]",
    "other_ascii": r"[+/=@\[\\\]^_`{}~\x00-\x08\x0E-\x1F\x7F]",
    "wide_letter": r"[\p{L}&&[^\x00-\x7F]]",
    "wide_other": r"[^\p{L}\x00-\x7F]",
}
MIN_CHARS = 200
MIN_WORDS = 150
MAX_CHAR_DISTANCE = 0.32
MAX_WORD_DISTANCE = 0.26
#: Length classes (powers of two of words) with so many reference texts have a word limit of their own,
#: which lies FENCE times the upper quartile's distance from the median above that quartile.
ENOUGH = 100
FENCE = 4
FENCED_WORDS = 64
_STEPS = 10_000


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda n, x: n + x)


def measure(docs: DataFrame, languages: dict[str, str] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, lang, the counts, ``chars`` and ``common`` (histograms)."""
    listed = languages or COMMON
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.col("lang"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", WHITE), ""))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    window = F.transform(
        F.sequence(F.lit(0), F.size("hashes") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(WINDOW)]),
    )
    rows = rows.withColumn("windows", F.when(F.size("hashes") > WINDOW, window))
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn(
        "ranked",
        F.when(
            twice,
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    rows = rows.withColumn(
        "places",
        F.array_sort(
            F.transform(
                F.filter(
                    F.transform(
                        "ranked",
                        lambda x, k: F.struct(
                            x["i"].alias("i"),
                            (
                                F.coalesce(F.get(F.col("ranked"), k - 1)["h"] == x["h"], F.lit(False))
                                | F.coalesce(F.get(F.col("ranked"), k + 1)["h"] == x["h"], F.lit(False))
                            ).alias("again"),
                        ),
                    ),
                    lambda x: x["again"],
                ),
                lambda x: x["i"],
            )
        ),
    )
    repeated = _sum(
        F.transform(
            "places",
            lambda p, k: F.least(
                F.coalesce(F.get(F.col("places"), k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)
            ),
        )
    )
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    counts = [F.size(F.regexp_extract_all("text", F.lit(c), F.lit(0))) for c in CLASSES.values()]
    every = sorted({word for words in listed.values() for word in words.split()})
    rows = rows.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length("text").cast("long").alias("n_chars"),
        F.array(*counts).alias("classes"),
        lines.alias("lines"),
        F.coalesce(repeated, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array_join(F.filter("words", lambda w: w.isin(*every)), "  ").alias("met"),
    )
    rows = rows.withColumn("met", F.concat(F.lit(" "), "met", F.lit(" ")))
    of_word = {
        word: (F.length("met") - F.length(F.replace("met", F.lit(f" {word} ")))) / (len(word) + 2)
        for word in every
    }
    rest = F.col("n_chars") - _sum("classes")
    return rows.select(
        "doc_id",
        "lang",
        "n_words",
        "word_chars",
        F.get("classes", F.lit(list(CLASSES).index("symbol"))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        "n_chars",
        F.concat(F.col("classes").cast("array<double>"), F.array(rest.cast("double"))).alias("chars"),
        F.array(*[of_word[word].cast("double") for word in every]).alias("common"),
    )


def references(measured: DataFrame, languages: dict[str, str] | None = None) -> dict[str, dict]:
    """Per listed language that occurs: shares of the character classes and of its common words.

    One row per listed language comes to the driver, however many texts there are.
    """
    listed = languages or COMMON
    every = sorted({word for words in listed.values() for word in words.split()})
    size = len(CLASSES) + 1
    sums = measured.where(F.col("lang").isin(*listed)).groupBy("lang").agg(
        F.array(*[F.sum(F.get("chars", F.lit(i))) for i in range(size)]).alias("chars"),
        F.array(*[F.sum(F.get("common", F.lit(i))) for i in range(len(every))]).alias("common"),
        F.sum("n_words").alias("n_words"),
    )
    found = {}
    for row in sorted(sums.collect(), key=lambda r: r["lang"]):
        n_chars, n_words = sum(row["chars"]), row["n_words"]
        if not n_chars or not n_words:
            continue
        places = [every.index(word) for word in sorted(set(listed[row["lang"]].split()))]
        found[row["lang"]] = {
            "chars": [n / n_chars for n in row["chars"]],
            "places": places,
            "words": [row["common"][i] / n_words for i in places],
        }
    return found


def _half(p: Column, q: Column) -> Column:
    """The part of one bin in the Jensen-Shannon divergence, in bits."""
    middle = (p + q) / 2
    return (
        F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0)
        + F.when(q > 0, q * F.log2(q / middle)).otherwise(0.0)
    ) / 2


def _distance(shares: Column, reference: list[float]) -> Column:
    parts = F.zip_with(shares, F.array(*[F.lit(float(q)) for q in reference]), _half)
    return F.sqrt(F.aggregate(parts, F.lit(0.0), lambda n, x: n + x))


def _length_class(n_words: Column) -> Column:
    return F.floor(F.log2(F.greatest(n_words, F.lit(1)))).cast("int")


def word_limits(rows: DataFrame) -> dict[int, float]:
    """The largest word distance allowed per length class, of ``n_words`` and ``distance`` of reference texts.

    Counts of distances in steps of 1 / 10,000 come to the driver, so quartiles do not depend on the order
    of rows. A class with few texts takes the limit of the next shorter one, whose texts lie farther.
    """
    step = F.round(F.col("distance") * _STEPS).cast("int")
    rows = rows.select(_length_class(F.col("n_words")).alias("size"), step.alias("step"))
    counts: dict[int, list[tuple[int, int]]] = {}
    for row in rows.groupBy("size", "step").agg(F.count("*").alias("n")).collect():
        counts.setdefault(row["size"], []).append((row["step"], row["n"]))
    limits, limit = {}, None
    for size in range(max(counts, default=-1) + 1):
        steps = sorted(counts.get(size, []))
        total = sum(n for _, n in steps)
        if total >= ENOUGH:
            quarters, seen = {}, 0
            for at, n in steps:
                seen += n
                for share in (2, 3):
                    if 4 * seen >= share * total:
                        quarters.setdefault(share, at)
            limit = (quarters[3] + FENCE * (quarters[3] - quarters[2])) / _STEPS
        if limit is not None:
            limits[size] = limit
    return limits


def judge(
    docs: DataFrame,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    min_chars: int = MIN_CHARS,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per row of ``docs`` with its counts, distances and verdict.

    Words are separated by ASCII white space. NULL text counts as empty: no words, all counts 0, and
    base_failed. Repeated rows are judged each. Rows of unlisted or NULL languages are judged like
    others but add to no reference; without any reference only the base rule counts. A text fails
    when its class distance to every language is too large, or its common-word distance, each only
    from the minimum length on. The word distance is judged for texts of listed languages only, by
    :func:`word_limits` where the table has enough texts of that length and by ``max_word_distance``
    from ``min_words`` on otherwise. Other columns of ``docs`` are ignored.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    measured = scratch.write(measure(docs), "measured")
    known = references(measured)
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    measured = measured.withColumn(
        "class_shares", F.transform("chars", lambda n: n / F.greatest("n_chars", F.lit(1)))
    ).withColumn(
        "word_shares", F.transform("common", lambda n: n / F.greatest("n_words", F.lit(1)))
    )
    by_class, by_word = [], []
    for language in known.values():
        by_class.append(_distance(F.col("class_shares"), language["chars"]))
        places = F.array(*[F.lit(i) for i in language["places"]])
        own = F.transform(places, lambda i: F.get(F.col("word_shares"), i))
        rest = F.aggregate(own, F.lit(1.0), lambda n, x: n - x)
        by_word.append(
            _distance(
                F.concat(own, F.array(F.greatest(rest, F.lit(0.0)))),
                [*language["words"], 1 - sum(language["words"])],
            )
        )

    def nearest(distances: list[Column]) -> Column:
        if not distances:
            return F.lit(None).cast("double")
        return F.least(*distances) if len(distances) > 1 else distances[0]

    word_distance = nearest(by_word)
    own = F.coalesce(F.col("lang").isin(*known), F.lit(False)) if known else F.lit(False)
    compared = measured.where(own & ~base_failed & (F.col("n_words") >= FENCED_WORDS))
    limits = word_limits(compared.select("n_words", word_distance.alias("distance"))) if known else {}
    limit = F.when(F.col("n_words") >= min_words, F.lit(float(max_word_distance)))
    if limits:
        first, last = min(limits), max(limits)
        size = F.least(_length_class(F.col("n_words")), F.lit(last))
        fenced = F.get(F.array(*[F.lit(limits[k]) for k in range(first, last + 1)]), size - first)
        limit = F.when((F.col("n_words") >= FENCED_WORDS) & (size >= first), fenced).otherwise(limit)
    rows = measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        F.when(F.col("n_chars") >= min_chars, nearest(by_class)).alias("char_distance"),
        F.when(limit.isNotNull(), word_distance).alias("word_distance"),
        F.when(own, limit).alias("word_limit"),
    )
    far = F.coalesce(F.col("char_distance") > max_char_distance, F.lit(False)) | F.coalesce(
        F.col("word_distance") > F.col("word_limit"), F.lit(False)
    )
    return rows.withColumn("kept", ~F.col("base_failed") & ~far)
