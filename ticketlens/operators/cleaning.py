"""From the text stage to typed, unique, complete tickets.

Order of the steps matters: copies of a ticket are dropped before completeness is looked at, so a
ticket whose first copy is incomplete is lost even if a later copy is complete.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import (
    any_blank,
    as_decimal,
    as_small_integer,
    as_timestamp,
    filled,
    is_blank,
    none_blank,
    title_case,
)
from ..schema import REQUIRED_FIELDS, STAGE_COLUMNS, Range, Rules
from ..sources.shared import pinned
from .repeats import split_repeated

PROBLEMS = "problems"


def dedupe(df: DataFrame, key: str, order: list[Column], tiebreak=()) -> DataFrame:
    """Keep the first row of every key.

    Rows whose key occurs once stay where they are; only the others are ordered and shuffled. The filter on the
    row number lets Spark keep one row per key in every task before the shuffle, so a key with very many
    copies costs one row per task.
    """
    single, again = split_repeated(df, key)
    by = [*[c.asc_nulls_last() for c in order], *[F.col(c).asc_nulls_last() for c in tiebreak]]
    copy = F.row_number().over(Window.partitionBy(key).orderBy(*by))
    first = again.withColumn("_copy", copy).where(F.col("_copy") == 1).drop("_copy")
    return single.unionByName(first)


def dedupe_tickets(stage: DataFrame, tiebreak=()) -> DataFrame:
    """The earliest copy of every ticket. Rows without a ticket id are not tickets yet.

    Ids are trimmed first, so padded copies count as copies. Copies of the same time are ordered by
    ``tiebreak`` and then by all columns; rows equal in all of them are the same row.
    """
    named = stage.withColumn("ticket_id", filled("ticket_id")).where("ticket_id IS NOT NULL")
    order = [as_timestamp("created_at"), F.col("created_at")]
    rest = [c for c in STAGE_COLUMNS if c not in ("ticket_id", "created_at", *tiebreak)]
    return dedupe(named, "ticket_id", order, [*tiebreak, *rest])


def typed_columns() -> dict[str, Column]:
    return {
        "ticket_id": F.trim("ticket_id"),
        "customer_id": filled("customer_id"),
        "customer_region": title_case(filled("customer_region")),
        "agent_id": filled("agent_id"),
        "agent_name": filled("agent_name"),
        "channel": filled("channel"),
        "category": filled("category"),
        "created_at": as_timestamp("created_at"),
        "first_response_minutes": as_decimal("first_response_minutes", 7),
        "resolution_hours": as_decimal("resolution_hours", 6),
        "csat_score": as_small_integer("csat_score"),
    }


TEXT_COLUMNS = (
    "ticket_id",
    "customer_id",
    "customer_region",
    "agent_id",
    "agent_name",
    "channel",
    "category",
)
CAST_COLUMNS = ("created_at", "first_response_minutes", "resolution_hours", "csat_score")


def typed(stage: DataFrame) -> DataFrame:
    """The stage with trimmed texts and cast values; what cannot be cast becomes NULL."""
    values = typed_columns()
    return stage.select(*[values[c].alias(c) for c in STAGE_COLUMNS])


def inside(value: Column, allowed: Range) -> Column:
    """Whether the value is in the range; NULL for a missing one."""
    low = F.lit(allowed.low)
    good = value > low if allowed.open_low else value >= low
    return good if allowed.high is None else good & (value <= F.lit(allowed.high))


def _rule_tests(rules: Rules) -> dict[str, Column]:
    """For every rule, when a staged row breaks it. A test may be NULL, which is no breach."""
    values = typed_columns()
    tests: dict[str, Column] = {}
    for c in STAGE_COLUMNS:
        if c not in rules.required and c != "ticket_id":
            tests[f"{c}: blank"] = is_blank(c)
        if c in CAST_COLUMNS:
            tests[f"{c}: cast"] = ~is_blank(c) & values[c].isNull()
        if c in rules.domains:
            tests[f"{c}: domain"] = ~values[c].isin(*rules.domains[c])
        if c in rules.ranges:
            tests[f"{c}: range"] = ~inside(values[c], rules.ranges[c])
        if c in rules.max_lengths:
            tests[f"{c}: length"] = F.length(values[c]) > rules.max_lengths[c]
    return tests


def _sound(rules: Rules) -> Column:
    """True where a complete row breaks no rule: the opposite of the tests, each value looked at once.

    A blank or uncastable value is NULL, its condition is then NULL, and a filter drops the row.
    """
    values = typed_columns()
    conditions = []
    for c in STAGE_COLUMNS:
        if c in rules.max_lengths:
            conditions.append(F.length(values[c]) <= rules.max_lengths[c])
        if c in rules.domains:
            conditions.append(values[c].isin(*rules.domains[c]))
        if c in rules.ranges:
            conditions.append(inside(values[c], rules.ranges[c]))
        if not any(c in limits for limits in (rules.max_lengths, rules.domains, rules.ranges)):
            conditions.append(values[c].isNotNull())
    return reduce(and_, conditions)


def clean_copies(copies: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Typed tickets from first copies: complete and within the rules."""
    return typed(copies.where(none_blank(rules.required) & _sound(rules)))


def clean_tickets(stage: DataFrame, rules: Rules = Rules(), tiebreak=()) -> DataFrame:
    """Typed tickets: unique, complete and within the rules."""
    return clean_copies(dedupe_tickets(stage, tiebreak), rules)


def quarantine(
    stage: DataFrame, rules: Rules = Rules(), tiebreak=(), copies: DataFrame | None = None
) -> DataFrame:
    """Rows the clean table cannot take, as staged, with the reasons.

    Rows without a ticket id are held back before copies are dropped. Incomplete tickets are not
    here; they are dropped and counted by :func:`incomplete`. ``copies`` are the stage's first copies,
    where they are at hand.
    """
    firsts = dedupe_tickets(stage, tiebreak) if copies is None else copies
    unnamed = stage.where(is_blank("ticket_id")).withColumn(
        PROBLEMS, F.array(F.lit("ticket_id: blank"))
    )
    reasons = [F.when(test, name) for name, test in _rule_tests(rules).items()]
    broken = (
        firsts.where(none_blank(rules.required))
        .withColumn(PROBLEMS, F.array_compact(F.array(*reasons)))
        .where(F.size(PROBLEMS) > 0)
    )
    held = unnamed.unionByName(broken)
    return held.select(*STAGE_COLUMNS, F.concat_ws("; ", PROBLEMS).alias(PROBLEMS))


def clean(
    stage: DataFrame, rules: Rules = Rules(), tiebreak=(), strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The clean table and the quarantine. ``strict`` raises if anything is held back."""
    copies = pinned(dedupe_tickets(stage, tiebreak), "first-copies")
    good, held = clean_copies(copies, rules), quarantine(stage, rules, copies=copies)
    if strict and not held.isEmpty():
        raise ValueError("the stage holds rows that break the rules; see the quarantine")
    return good, held


def incomplete(
    stage: DataFrame,
    required=REQUIRED_FIELDS,
    per: str = "row",
    tiebreak=(),
    copies: DataFrame | None = None,
) -> DataFrame:
    """How many distinct rows, or first copies of tickets, lack a required field."""
    if per == "row":
        gaps = stage.select(*STAGE_COLUMNS).where(any_blank(required)).distinct()
        return gaps.agg(F.count("*").alias("incomplete_rows"))
    firsts = dedupe_tickets(stage, tiebreak) if copies is None else copies
    gaps = firsts.where(any_blank(required))
    return gaps.agg(F.count("*").alias("incomplete_tickets"))


def losses(stage: DataFrame, copies: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Where the raw rows went, as one row; the causes and the clean rows add up to the raw rows.

    A row is counted for the first cause it meets: no ticket id, a later copy of a ticket, an empty
    required field, a broken rule. ``copies`` are the first copies of the stage's tickets.
    """
    complete = none_blank(rules.required)
    sound = F.coalesce(_sound(rules), F.lit(False))
    kept = copies.agg(
        F.struct(
            F.count("*").alias("tickets"),
            F.count_if(~complete).alias("incomplete"),
            F.count_if(complete & ~sound).alias("quarantined"),
        )
    ).scalar()
    raw = stage.agg(
        F.count("*").alias("raw_rows"), F.count_if(is_blank("ticket_id")).alias("without_id")
    )
    counted = raw.withColumn("kept", kept).select("raw_rows", "without_id", "kept.*")
    return counted.select(
        "raw_rows",
        "without_id",
        (F.col("raw_rows") - F.col("without_id") - F.col("tickets")).alias("later_copies"),
        "incomplete",
        "quarantined",
        (F.col("tickets") - F.col("incomplete") - F.col("quarantined")).alias("clean_rows"),
    )


def strict_clean(stage: DataFrame) -> DataFrame:
    """The stricter rule: whole-row copies dropped, and every row with any blank field.

    Only rows that occur again are held against each other; the others are never folded or shuffled.
    """
    single, again = split_repeated(stage.where(none_blank(STAGE_COLUMNS)).select(*STAGE_COLUMNS), *STAGE_COLUMNS)
    full = single.unionByName(again.dropDuplicates())
    return full.withColumn("csat_score", as_small_integer("csat_score").cast("int"))
