"""Conversations as training text in windows of a token budget, with a loss mask.

Every turn is rendered as ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line
break. Control strings inside texts are escaped: ``<|`` becomes ``<\\|``, ``<\\|`` becomes ``<\\\\|``
and so on, one backslash more each time, which can be undone. In roles ``%``, ``<`` and line breaks are
percent-encoded.

Prefix sums of the turns' tokens choose where a window ends: it takes whole turns up to the budget,
begins with the conversation's system turn and repeats the last turns before it as far as the history
limit allows. Turns stay rows until they meet the others of their slice of a conversation, whose size is
bounded, so no task ever holds a whole conversation. Only assistant texts that a window holds for the first time carry loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.scratch import Scratch

#: The markers of the template.
START, END = "<|im_start|>", "<|im_end|>"

_FROM_START = Window.unboundedPreceding

BUDGET = 512
HISTORY = 128
#: Budgets of text in a slice of a conversation, which one row holds while it is formatted.
SLICE = 128

#: What a slice holds: the repeated system turns, history from the slice before, turns of its own.
_SYSTEM, _BACK, _OWN = 0, 1, 2
#: Characters of role and text by which turns are ranged.
_RANGED = 64

_END_PATTERN = r"<\|im_end\|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    for raw, coded in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(raw), F.lit(coded))
    return role


def unescape_role(role: Column) -> Column:
    for raw, coded in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(coded), F.lit(raw))
    return role


def count_tokens(text: Column) -> Column:
    """Words and single marks, a stand-in for a tokenizer that runs inside Spark."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]"))


def _head(role: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"))


def _cuts(body: Column, own: Column, room: Column) -> Column:
    """Places in the body at which a window starts; turns before the ``own``-th belong to earlier slices."""
    start = F.struct(
        F.array(own).alias("cuts"),
        F.element_at("sums", own + 1).alias("first"),
        own.alias("at"),
    )

    def step(state: Column, turn: Column) -> Column:
        over = (turn["until"] - state["first"] > room) & (turn["before"] > state["first"])
        return F.struct(
            F.when(over, F.concat(state["cuts"], F.array(state["at"])))
            .otherwise(state["cuts"])
            .alias("cuts"),
            F.when(over, turn["before"]).otherwise(state["first"]).alias("first"),
            (state["at"] + 1).alias("at"),
        )

    return F.aggregate(F.slice(body, own + 1, F.size(body)), start, step, lambda state: state["cuts"])


def _placed(turns: DataFrame, tokens: Column | None) -> DataFrame:
    """Turns with the tokens of their conversation before them, and of its system turns and of all its turns.

    Rows are ranged by conversation and turn, so a large conversation lies in many parts; sums run within
    a part, and what the parts before it hold is added. Ranges are cut by the first characters of role and
    text; rows that are wholly alike may fall in different parts.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    counted = (count_tokens(text) + 4 if tokens is None else tokens).cast("long")
    rows = turns.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.greatest(counted, F.lit(1).cast("long")).alias("tokens"),
        F.monotonically_increasing_id().alias("n"),
    )
    plain = F.length("role") <= _RANGED
    whole = plain & (F.length("text") <= _RANGED)
    ranged = rows.repartitionByRange(
        "conv_id",
        "turn",
        F.left("role", F.lit(_RANGED)),
        ~plain,
        F.when(plain, F.left("text", F.lit(_RANGED))),
        ~whole,
        F.when(whole, F.col("n")),
    ).sortWithinPartitions("conv_id", "turn", "role", "text", "n")
    parts = ranged.select(
        "conv_id",
        "role",
        "text",
        "tokens",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("pos"),
    )
    in_part = Window.partitionBy("part", "conv_id").orderBy("pos").rowsBetween(_FROM_START, 0)
    parts = Scratch(turns.sparkSession, "turns").write(
        parts.withColumn("until", F.sum("tokens").over(in_part)).drop("pos"), "parts"
    )
    before = F.col("until") - F.col("tokens")
    sums = parts.groupBy("part", "conv_id").agg(
        F.sum("tokens").alias("held"), F.min(F.when(F.col("role") != "system", before)).alias("other")
    )
    conv = Window.partitionBy("conv_id")  # one row for each part that the conversation lies in
    earlier = conv.orderBy("part").rowsBetween(_FROM_START, -1)
    sums = sums.withColumn("offset", F.coalesce(F.sum("held").over(earlier), F.lit(0).cast("long")))
    total = F.sum("held").over(conv)
    sums = sums.select(
        F.col("part").alias("of_part"),
        F.col("conv_id").alias("of_conv"),
        "offset",
        total.alias("total"),
        F.coalesce(F.min(F.col("offset") + F.col("other")).over(conv), total).alias("leading"),
    )
    same = (F.col("part") == F.col("of_part")) & F.col("conv_id").eqNullSafe(F.col("of_conv"))
    return parts.join(sums, same).select(
        "conv_id",
        "role",
        _head(escape_role(F.col("role"))).alias("head"),
        escape(F.col("text")).alias("body"),
        "tokens",
        (F.col("offset") + before).alias("before"),
        (F.col("offset") + F.col("until")).alias("until"),
        "total",
        "leading",
    )


def format_windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Column | None = None
) -> DataFrame:
    """Rows conv_id, window, n_system, n_history, n_new, tokens, formatted, loss.

    ``turns`` has conv_id, turn, role and text; other columns are ignored. NULL roles and texts count
    as empty. Turns are taken in the order of turn, then role, then text; a NULL turn is first and
    repeated rows are turns of their own. All rows with a NULL conv_id form one conversation. An
    empty table gives no window. ``loss`` lists the spans of ``formatted``, in code points with an
    exclusive end, that are trained on. ``tokens`` is a count per turn, by default
    :func:`count_tokens` of the text plus 4 for the markers; missing counts and those below 1 are 1. The
    leading turns of role ``system`` are repeated in every window, if they take no more than half of what
    the history leaves of the budget.
    Larger ones are turns like any other: they are shown once, ``n_system`` is 0, and repeating them
    cannot multiply the output. A turn that is larger than what the budget leaves gets a window of its
    own without history; no other window exceeds the budget.

    A conversation of any length is cut in slices of :data:`SLICE` budgets by the running sum of its
    tokens. Windows end with their slice too, so slices are formatted apart from each other, each with the
    system turns and the history it needs from the slice before. ``window`` rises along the conversation; it
    counts from 0 in the first slice and from slice x SLICE x budget in the others.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be smaller than the budget")
    span = SLICE * budget
    rows = _placed(turns, tokens)
    number = F.floor(F.col("before") / span)
    last_slice = F.floor((F.col("total") - 1) / span)
    lead = (F.col("leading") <= (budget - history) // 2) & (F.col("before") < F.col("leading"))
    tail_of_slice = (F.col("before") >= (number + 1) * span - history) & (number < last_slice)

    def sent(to: Column, kind: Column) -> Column:
        return F.struct(to.alias("slice"), kind.alias("kind"))

    none = F.array().cast("array<struct<slice:bigint,kind:int>>")
    one = F.lit(1).cast("long")
    places = F.concat(
        F.array(sent(number, F.when(lead, _SYSTEM).otherwise(_OWN))),
        F.when(
            lead & (last_slice > 0),
            F.transform(F.sequence(one, F.greatest(last_slice, one)), lambda s: sent(s, F.lit(_SYSTEM))),
        ).otherwise(none),
        F.when(~lead & tail_of_slice, F.array(sent(number + 1, F.lit(_BACK)))).otherwise(none),
    )
    rows = rows.withColumn("place", F.explode(places))
    turn = F.struct("place.kind", "before", "until", "role", "head", "body", "tokens")
    slices = rows.groupBy("conv_id", F.col("place.slice").alias("slice")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns")
    )
    slices = slices.select(
        "conv_id",
        "slice",
        F.filter("turns", lambda t: t["kind"] == _SYSTEM).alias("system"),
        F.filter("turns", lambda t: t["kind"] != _SYSTEM).alias("body"),
        F.size(F.filter("turns", lambda t: t["kind"] == _BACK)).alias("n_back"),
    ).where("slice = 0 OR size(body) > n_back")  # a turn may be larger than a slice
    # sums[i]: the tokens before turn i of the body; one entry more for those of all turns
    slices = slices.withColumn("n_system", F.size("system")).withColumn(
        "sums",
        F.concat(
            F.transform("body", lambda t: t["before"]),
            F.array(F.coalesce(F.get("body", F.size("body") - 1)["until"], F.lit(0).cast("long"))),
        ),
    ).withColumn(
        "system_tokens",
        F.aggregate("system", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]),
    )
    room = F.lit(budget - history).cast("long") - F.col("system_tokens")
    slices = slices.withColumn("cuts", _cuts(F.col("body"), F.col("n_back"), room))
    windows = slices.select("*", F.posexplode(F.col("cuts")).alias("nth", "first")).withColumn(
        "last",
        F.coalesce(F.try_element_at("cuts", F.col("nth") + 2), F.size("body")),
    )
    windows = windows.withColumn("window", F.col("slice") * span + F.col("nth"))
    before = F.element_at("sums", F.col("first") + 1)
    until = F.element_at("sums", F.col("last") + 1)
    kept_back = F.when(
        until - before <= room,
        F.size(
            F.filter(
                F.slice("sums", F.lit(1), F.col("first")), lambda s: s >= before - F.lit(history)
            )
        ),
    ).otherwise(0)
    windows = windows.withColumn("n_history", F.when(F.col("first") > 0, kept_back).otherwise(0))
    windows = windows.withColumn(
        "shown",
        F.concat(
            "system",
            F.slice(
                "body",
                F.col("first") - F.col("n_history") + 1,
                F.col("last") - F.col("first") + F.col("n_history"),
            ),
        ),
    )
    tail = F.lit(END + "\n")
    ends = F.aggregate(
        "shown",
        F.array(F.lit(0)),
        lambda at, t: F.concat(
            at,
            F.array(
                F.element_at(at, -1) + F.length(t["head"]) + F.length(t["body"]) + F.length(tail)
            ),
        ),
    )
    repeated = F.when(F.col("window") > 0, F.col("n_system")).otherwise(0) + F.col("n_history")
    spans = F.transform(
        "shown",
        lambda t, i: F.struct(
            (t["role"] == "assistant").alias("target"),
            (F.element_at(F.col("ends"), i + 1) + F.length(t["head"])).alias("start"),
            (F.element_at(F.col("ends"), i + 2) - F.length(tail)).alias("end"),
        ),
    )
    return windows.withColumn("ends", ends).select(
        "conv_id",
        "window",
        "n_system",
        "n_history",
        (F.col("last") - F.col("first")).alias("n_new"),
        F.aggregate("shown", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("tokens"),
        F.array_join(
            F.transform("shown", lambda t: F.concat(t["head"], t["body"], tail)), ""
        ).alias("formatted"),
        F.transform(
            F.filter(
                F.slice(spans, repeated + 1, F.greatest(F.size("shown"), F.lit(1))),
                lambda s: s["target"],
            ),
            lambda s: F.struct(s["start"], s["end"]),
        ).alias("loss"),
    )


def read_each(windows: DataFrame) -> DataFrame:
    """Per window, read from its formatted text alone: conv_id, window, turns, loss_texts and chars.

    ``turns`` has role and text of the turns that the window holds for the first time, so each turn of a
    conversation is in one window only.
    """
    pieces = F.split("formatted", _END_PATTERN, -1)
    skipped = F.when(F.col("window") > 0, F.col("n_system")).otherwise(0) + F.col("n_history")
    fresh = F.slice(pieces, skipped + 1, F.greatest(F.size(pieces) - 1 - skipped, F.lit(0)))

    def turn(piece: Column) -> Column:
        line = F.locate("\n", piece)
        return F.struct(
            unescape_role(F.substring(piece, F.lit(len(START) + 1), line - len(START) - 1)).alias(
                "role"
            ),
            unescape(F.substring(piece, line + 1, F.length(piece))).alias("text"),
        )

    return windows.select(
        "conv_id",
        "window",
        F.transform(fresh, turn).alias("turns"),
        F.transform(
            "loss",
            lambda s: unescape(F.substring("formatted", s["start"] + 1, s["end"] - s["start"])),
        ).alias("loss_texts"),
        F.length("formatted").cast("long").alias("chars"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Per conversation: conv_id, turns (array of role and text, each once), loss_texts, formatted_chars.

    A conversation is one row here, as large as its text; :func:`read_each` gives rows of bounded size.
    """
    parts = F.array_sort(F.collect_list(F.struct("window", "turns", "loss_texts")))
    return read_each(windows).groupBy("conv_id").agg(
        parts.alias("parts"), F.sum("chars").alias("formatted_chars")
    ).select(
        "conv_id",
        F.flatten(F.transform("parts", lambda p: p["turns"])).alias("turns"),
        F.flatten(F.transform("parts", lambda p: p["loss_texts"])).alias("loss_texts"),
        "formatted_chars",
    )
