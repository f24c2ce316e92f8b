"""Fill-in-middle: each text is cut in three at token bounds, and the middle moves to the end.

``regexp_count`` gives the number of tokens. Two draws from a hash of the id give the cuts, and a pattern made
for the row, with possessive groups of exactly so many tokens, captures prefix, middle and suffix in one match;
the replacement writes them in their new order. Possessive groups never give a token back, so a match
takes time in proportion to the text and no stack, however long the text is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: A token is a word with the white space before it; white space at the end is one of its own.
TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_UNIT = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"

_ORDERS = {
    "psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2",
    "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2",
}


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four whole numbers of 32 bits."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.sha2(text, 256)
    return [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (tokens), form, prefix_chars, middle_chars, output.

    Of 100 texts ``rate`` are transformed, and of 100 of these ``spm_rate`` have the suffix first (``spm``), the
    others the prefix (``psm``). The rest, empty texts and those that contain a control string stay ``plain``:
    their output is the text and their lengths are NULL. A NULL text counts as empty, a NULL doc_id draws as an
    empty id. Rows with the same doc_id draw alike. An empty table gives an empty result, and other columns
    are ignored, whatever their names.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    first, second, third, fourth = _draws(F.col("doc_id"), seed)
    room = F.col("n") + 1
    cuts = rows.select(
        "*",
        F.regexp_count("text", F.lit(TOKEN)).cast("long").alias("n"),
        first.alias("h1"),
        second.alias("h2"),
        third.alias("h3"),
        fourth.alias("h4"),
    ).select(
        "*",
        F.least(F.col("h1") % room, F.col("h2") % room).alias("a"),
        F.greatest(F.col("h1") % room, F.col("h2") % room).alias("b"),
    )
    held = [F.contains("text", F.lit(mark)) for mark in (PREFIX, SUFFIX, MIDDLE)]
    plain = (F.col("text") == "") | held[0] | held[1] | held[2] | (F.col("h3") % 100 >= rate)
    formed = cuts.withColumn(
        "form",
        F.when(plain, "plain").when(F.col("h4") % 100 < spm_rate, "spm").otherwise("psm"),
    )
    pattern = F.format_string(
        rf"(?s)\A(%s{{%d}}+)(%s{{%d}}+)(.*)\z", F.lit(_UNIT), F.col("a"), F.lit(_UNIT), F.col("b") - F.col("a")
    )
    order = F.when(F.col("form") == "spm", _ORDERS["spm"]).otherwise(_ORDERS["psm"])
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(
        F.regexp_replace(F.col("text"), pattern, order)
    )
    parts = formed.select("doc_id", "n", "form", output.alias("output"))
    return parts.select("*", *_lengths(F.col("output"), F.col("form"))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output"
    )


def _middle(output: Column) -> Column:
    return F.substring_index(output, MIDDLE, -1)


def _prefix(output: Column) -> Column:
    after = F.substring_index(output, PREFIX, -1)
    return F.substring_index(F.substring_index(after, SUFFIX, 1), MIDDLE, 1)


def _lengths(output: Column, form: Column) -> list[Column]:
    def of(part: Column) -> Column:
        return F.when(form != "plain", F.length(part)).cast("long")

    return [of(_prefix(output)).alias("prefix_chars"), of(_middle(output)).alias("middle_chars")]


def restore(output: Column, form: Column) -> Column:
    """The text that an output of :func:`transform` was made of, from the output and its form alone.

    No text that was cut contains a control string, and none can arise where a part meets one.
    """
    after = F.substring_index(output, SUFFIX, -1)
    suffix = F.substring_index(F.substring_index(after, PREFIX, 1), MIDDLE, 1)
    return F.when(form == "plain", output).otherwise(F.concat(_prefix(output), _middle(output), suffix))
