r"""Secrets in texts: patterns that are strong alone, and weak parts linked to their complements.

Strong (base) kinds are assignments, access identifiers and hex runs. Weak kinds are temporary or
named identifiers, mixed 40-character strings and endpoints, which mean little alone. A weak candidate is
reported only when the parts that complete it lie within ``scope`` code points: an identifier needs
a secret, a secret needs an identifier or an endpoint, an endpoint needs both.

Spans come from two functions that walk the text alike: the pieces between matches and the matches.
Their lengths, summed, are the positions. The interval join buckets positions by scope and meets
parts that are already reduced to one row per bucket and class, so no pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.scratch import Scratch

#: The kinds in the order of their rank, and their patterns.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
BASE = KINDS[:3]
PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
    "weak_id": r"""(?:ASIA|AIDA|AROA)[A-Z0-9]{12,}|(?i:client|account|user|key)_(?i:id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._-]{4,}""",
    "weak_secret": r"(?<![A-Za-z0-9/+])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+])",
    "endpoint": r"""(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp)://[^\s"'<>]{4,}""",
}
CLASSES = {
    "assign": "secret",
    "access": "id",
    "hex": "secret",
    "weak_id": "id",
    "weak_secret": "secret",
    "endpoint": "endpoint",
}
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_IDS = ("client_id", "account_id", "user_id", "key_id")

MIN_VALUE = 6
MIN_ACCESS = 20
SCOPE = 300
MASK = "<SECRET>"


def _any(text: Column, strings: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for string in strings:
        found = found | F.contains(text, F.lit(string))
    return found


def _may_hold(text: Column, lower: Column) -> dict[str, Column]:
    """Cheap tests that a text without them holds no match of the kind."""
    return {
        "assign": _any(lower, _WORDS),
        "access": F.contains(text, F.lit("AKIA")),
        "hex": F.rlike(text, F.lit("[0-9a-f]{24}")),
        "weak_id": _any(text, ("ASIA", "AIDA", "AROA")) | _any(lower, _IDS),
        "weak_secret": F.rlike(text, F.lit(PATTERNS["weak_secret"])),
        "endpoint": F.contains(text, F.lit("://")),
    }


def _is_valid(kind: str, hit: Column) -> Column:
    if kind == "access":
        return F.length(hit) >= MIN_ACCESS
    if kind == "weak_secret":
        return F.rlike(hit, F.lit("[A-Z]")) & F.rlike(hit, F.lit("[a-z]")) & F.rlike(hit, F.lit("[0-9]"))
    return F.lit(True)


def _walk(kind: str, text: Column) -> Column:
    """For each match in order: code points before it since the last one, its size, whether it holds."""
    pattern = F.lit(PATTERNS[kind])
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), F.length)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    if kind == "assign":
        values = F.transform(F.regexp_extract_all(text, pattern, F.lit(2)), F.length)
        checked = F.zip_with(
            hits, values, lambda hit, value: F.struct(F.length(hit).alias("size"), (value >= MIN_VALUE).alias("ok"))
        )
    else:
        checked = F.transform(
            hits,
            lambda hit: F.struct(
                F.length(hit).alias("size"), _is_valid(kind, hit).alias("ok")
            ),
        )
    return F.zip_with(
        gaps,
        checked,
        lambda gap, hit: F.struct(gap.alias("gap"), hit["size"].alias("size"), hit["ok"].alias("ok")),
    )


def _walks(docs: DataFrame, keys: list[Column]) -> DataFrame:
    """Keys and ``found``: per kind with matches, the walk. Empty where the text holds nothing."""
    text = F.col("__text")
    rows = docs.select(*keys, F.coalesce("text", F.lit("")).alias("__text"))
    rows = rows.withColumn("__lower", F.lower("__text"))
    tests = _may_hold(text, F.col("__lower"))
    walks = [
        F.when(
            tests[kind],
            F.struct(F.lit(rank).alias("rank"), _walk(kind, text).alias("items")),
        )
        for rank, kind in enumerate(KINDS)
    ]
    return rows.withColumn("found", F.array_compact(F.array(*walks))).drop("__text", "__lower")


def _spans(walks: DataFrame, key: str) -> DataFrame:
    """One row per valid match: key, rank, start, end."""
    items = walks.select(key, F.explode("found").alias("one")).select(
        key, F.col("one.rank").alias("rank"), F.posexplode("one.items").alias("n", "item")
    )
    order = Window.partitionBy(key, "rank").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    # the piece behind the last match has no size and is no match
    return (
        items.where("item.size IS NOT NULL")
        .withColumn("end", F.sum(F.col("item.gap") + F.col("item.size")).over(order))
        .where("item.ok")
        .select(key, "rank", (F.col("end") - F.col("item.size")).alias("start"), "end")
    )


def _linked(spans: DataFrame, key: str, scope: int) -> DataFrame:
    """The weak spans whose complementary parts lie within the scope."""
    of_kind = F.element_at(
        F.array(*[F.lit(CLASSES[kind]) for kind in KINDS]), F.col("rank") + 1
    )
    spans = spans.withColumn("class", of_kind)
    covered = F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))
    parts = (
        spans.select(key, "class", "start", "end", F.explode(covered).alias("bucket"))
        .groupBy(key, "bucket")
        .agg(
            *[
                how(F.when(F.col("class") == one, F.col(side))).alias(f"{one}_{side}")
                for one in ("id", "secret", "endpoint")
                for how, side in ((F.min, "start"), (F.max, "end"))
            ]
        )
    )
    near = F.sequence(F.floor(F.col("start") / scope) - 1, F.floor(F.col("end") / scope) + 1)
    weak = spans.where(F.col("rank") >= len(BASE))
    weak = weak.select("*", F.explode(near).alias("bucket"))
    met = weak.join(parts, [key, "bucket"])

    def close(one: str) -> Column:
        return F.coalesce(
            (F.col(f"{one}_start") <= F.col("end") + scope)
            & (F.col(f"{one}_end") >= F.col("start") - scope),
            F.lit(False),
        )

    met = met.groupBy(key, "rank", "start", "end", "class").agg(
        *[F.max(close(one)).alias(one) for one in ("id", "secret", "endpoint")]
    )
    complete = (
        F.when(F.col("class") == "id", F.col("secret"))
        .when(F.col("class") == "secret", F.col("id") | F.col("endpoint"))
        .otherwise(F.col("id") & F.col("secret"))
    )
    return met.where(complete).select(key, "rank", "start", "end")


def _reported(scratch: Scratch, walks: DataFrame, key: str, scope: int) -> DataFrame:
    """Per key with spans: ``spans``, an array of start, rank and end in that order."""
    spans = scratch.write(_spans(walks.where(F.size("found") > 0), key), "spans")
    base = spans.where(F.col("rank") < len(BASE))
    every = base.unionByName(_linked(spans, key, scope))
    return every.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("start", "rank", "end"))).alias("spans")
    )


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``spans``, an array of start, end and kind.

    Positions are code points with an exclusive end, in the order of start, then kind as listed in
    ``KINDS``. NULL text counts as empty and has no span; repeated rows get a result each; a NULL doc_id is
    kept. Texts of any length are read whole. Other columns of ``docs`` are ignored.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    row = F.monotonically_increasing_id().alias("row")
    walks = scratch.write(_walks(docs, [F.col("doc_id"), row]), "walks")
    names = F.array(*[F.lit(kind) for kind in KINDS])
    spans = F.transform(
        F.coalesce("spans", F.expr("array()").cast("array<struct<start:bigint,rank:int,end:bigint>>")),
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.element_at(names, s["rank"] + 1).alias("kind"),
        ),
    )
    found = _reported(scratch, walks, "row", scope)
    return walks.select("doc_id", "row").join(found, "row", "left").select(
        "doc_id", spans.alias("spans")
    )


def mask_secrets(docs: DataFrame, scope: int = SCOPE, mask: str = MASK) -> DataFrame:
    """``docs`` with every reported span replaced by ``mask`` in text, and n_chars brought in line.

    All rows and columns stay. Overlapping spans are replaced together, once. NULL text stays NULL.
    """
    scratch = Scratch(docs.sparkSession, "secret-masks")
    digest = F.sha2("text", 256)
    held = _walks(docs, [digest.alias("__digest")]).where(F.size("found") > 0)
    walks = scratch.write(held.dropDuplicates(["__digest"]), "walks")
    found = _reported(scratch, walks, "__digest", scope)

    lower = F.lower("text")
    flagged = F.lit(False)
    for test in _may_hold(F.col("text"), lower).values():
        flagged = flagged | test
    rows = docs.select(
        F.struct(*docs.columns).alias("__row"),
        F.col("text").alias("__text"),
        F.coalesce(flagged, F.lit(False)).alias("__flagged"),
    )
    clean = rows.where("NOT __flagged").select("__row.*")
    hit = rows.where("__flagged").withColumn("__digest", F.sha2("__text", 256))
    hit = hit.join(found.withColumnRenamed("spans", "__spans"), "__digest", "left")

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        between = F.substring(
            "__text", state["at"].cast("int") + 1, (span["start"] - state["at"]).cast("int")
        )
        return F.struct(
            F.when(fresh, F.concat(state["out"], between, F.lit(mask)))
            .otherwise(state["out"])
            .alias("out"),
            F.greatest(state["at"], span["end"]).alias("at"),
        )

    masked = F.aggregate(
        "__spans",
        start,
        step,
        lambda s: F.concat(
            s["out"], F.substring("__text", s["at"].cast("int") + 1, F.length("__text"))
        ),
    )
    hit = hit.withColumn("__text", F.coalesce(masked, "__text"))
    changed = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        size = F.length("__text").cast(docs.schema["n_chars"].dataType)
        size = F.when(F.col("__spans").isNull(), F.col("__row.n_chars")).otherwise(size)
        changed["n_chars"] = size
    hit = hit.select(*[changed.get(c, F.col(f"__row.{c}")).alias(c) for c in docs.columns])
    return clean.unionByName(hit)
