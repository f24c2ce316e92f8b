"""Workbook summaries and report datasets. Numbers here are unrounded unless they end up in text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_label, month_of
from ..functions.numeric import fixed_text, over_groups, plain_ratio
from ..operators.measures import grouped, regrouped
from ..schema import CLEAN_SCHEMA, THRESHOLD_HOURS
from ..sources.shared import write_table
from ..sources.staging import write_csv

# ---- fixed values: labels of the summaries ------------------------------------------------------
TOTAL_LABEL = "Total"
WITHIN_ROW = "Within {0}h (<={0})"
AFTER_ROW = "After {0}h (>{0})"
DROP_ROW = "CSAT drop after {0}h"
# -------------------------------------------------------------------------------------------------


def _avg(total: str, count: str = "tickets") -> Column:
    return plain_ratio(F.col(total), F.col(count))


def pivot_channel(tickets: DataFrame) -> DataFrame:
    """Channels in alphabetical order, then a total row that holds the count alone.

    The roll-up runs over the channel groups, so the tickets are not expanded.
    """
    rolled = (
        grouped(tickets, "channel")
        .rollup("channel")
        .agg(
            F.sum("tickets").alias("tickets"),
            F.sum("sum_csat").alias("sum_csat"),
            F.sum("sum_minutes").alias("sum_minutes"),
            F.grouping("channel").alias("is_total"),
        )
    )
    part = F.col("is_total") == 0
    all_tickets = over_groups(F.max(F.when(~part, F.col("tickets"))))
    return rolled.select(
        "is_total",
        F.when(part, F.col("channel")).otherwise(TOTAL_LABEL).alias("channel"),
        "tickets",
        F.when(part, plain_ratio(F.col("tickets"), all_tickets)).alias("share"),
        F.when(part, _avg("sum_csat")).alias("avg_csat"),
        F.when(part, _avg("sum_minutes")).alias("avg_first_response_min"),
    ).orderBy("is_total", F.asc_nulls_last("channel")).drop("is_total")


def pivot_category(tickets: DataFrame) -> DataFrame:
    """Categories by falling volume, held against one row of totals."""
    groups = grouped(tickets, "category")
    total = groups.agg(F.sum("tickets")).scalar()
    return groups.select(
        "category",
        "tickets",
        plain_ratio(F.col("tickets"), total).alias("share"),
        _avg("sum_csat").alias("avg_csat"),
        _avg("sum_hours").alias("avg_resolution_hrs"),
    ).orderBy(F.desc_nulls_first("tickets"), "category")


def pivot_resolution(tickets: DataFrame, threshold=THRESHOLD_HOURS) -> DataFrame:
    """Both buckets, always listed, and the drop between them as a fraction in its own row."""
    total = grouped(tickets, threshold=threshold)
    within, after = _avg("fast_csat", "fast_tickets"), _avg("late_csat", "late_tickets")
    no_count = F.lit(None).cast("bigint")
    cells = [
        (1, WITHIN_ROW, F.col("fast_tickets"), within),
        (2, AFTER_ROW, F.col("late_tickets"), after),
        (3, DROP_ROW, no_count, F.try_divide(within - after, within)),
    ]
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(label.format(f"{threshold:g}")).alias("resolution_bucket"),
            count.alias("tickets"),
            value.alias("avg_csat"),
        )
        for i, label, count, value in cells
    ]
    return total.select(F.inline(F.array(*rows))).orderBy("position").drop("position")


def pivot_monthly(tickets: DataFrame) -> DataFrame:
    """Tickets per month, the month as ``YYYY-MM``."""
    months = tickets.groupBy(month_of(tickets).alias("_month")).agg(F.count("*").alias("tickets"))
    return months.orderBy("_month").select(month_label(F.col("_month")).alias("month"), "tickets")


def agent_scorecard(tickets: DataFrame, agents: DataFrame, agent_id: str | Column) -> DataFrame:
    """One agent's numbers; no row for an unknown id.

    The id may be a text or a one-value subquery. The filter reaches the scan.
    """
    own = grouped(tickets.where(F.col("agent_id") == agent_id), "agent_id")
    return own.join(agents, "agent_id").select(
        "agent_id",
        "agent_name",
        "tickets",
        _avg("sum_csat").alias("avg_csat"),
        _avg("sum_hours").alias("avg_resolution_hrs"),
        _avg("sum_minutes").alias("avg_first_response_min"),
    )


def first_agent(tickets: DataFrame) -> Column:
    """The agent of the ticket with the lowest id: the one a new scorecard opens with."""
    return tickets.agg(F.min_by("agent_id", "ticket_id")).scalar()


def insights(tickets: DataFrame, threshold=THRESHOLD_HOURS) -> DataFrame:
    """Three sentences on channel mix, slow resolution and where to act; always three.

    One pass folds the tickets by channel and category. Those groups are added up by channel for the
    facts, and by category for the two that are late most often.
    """
    cells = grouped(tickets, "channel", "category", threshold=threshold)
    late_share = plain_ratio(F.col("late_tickets"), F.col("tickets"))
    latest = (
        regrouped(cells, "category")
        .select(late_share.alias("share"), "category")
        .orderBy(F.desc_nulls_last("share"), "category")
        .limit(2)
    )
    places = F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("share"), "category")))
    latest = latest.agg(places).scalar()

    def least(*cells: Column) -> Column:
        return F.min(F.struct(*cells))

    facts = regrouped(cells, "channel").agg(
        least((-F.col("tickets")).alias("n"), F.col("channel")).alias("top"),
        least((-_avg("sum_minutes")).alias("minutes"), F.col("channel")).alias("slow"),
        F.sum("tickets").alias("tickets"),
        F.sum("fast_tickets").alias("fast_n"),
        F.sum("fast_csat").alias("fast_s"),
        F.sum("late_tickets").alias("late_n"),
        F.sum("late_csat").alias("late_s"),
    )
    facts = facts.withColumn("latest", latest)

    wide = "decimal(38,0)"
    base = F.col("fast_s").cast(wide) * F.col("late_n")
    own = F.col("late_s").cast(wide) * F.col("fast_n")
    mix = F.concat(
        F.col("top.channel"),
        F.lit(" brings the most tickets: "),
        fixed_text(F.col("top.n") * -100, F.col("tickets"), 1),
        F.lit("% of them."),
    )
    slow = F.concat(
        F.lit(f"Beyond {threshold:g} hours satisfaction is "),
        fixed_text(F.col("late_s"), F.col("late_n"), 2),
        F.lit(", up to then "),
        fixed_text(F.col("fast_s"), F.col("fast_n"), 2),
        F.lit(": "),
        fixed_text((base - own) * 100, base, 1),
        F.lit("% less."),
    )
    act = F.concat(
        F.lit("Speed up "),
        F.array_join(F.transform("latest", lambda one: one["category"]), " and "),
        F.lit(f" tickets, which pass {threshold:g} hours most often, and "),
        F.col("slow.channel"),
        F.lit(", the channel slowest to respond."),
    )
    unknown = (
        "There are no tickets to compare channels by.",
        f"There are not tickets on both sides of {threshold:g} hours to compare.",
        "There are no tickets to act on.",
    )
    lines = [
        F.struct(F.lit(i).alias("position"), F.coalesce(text, F.lit(without)).alias("insight"))
        for i, (text, without) in enumerate(zip((mix, slow, act), unknown, strict=True), start=1)
    ]
    return facts.select(F.inline(F.array(*lines))).orderBy("position")


def data_dictionary(clean: DataFrame) -> DataFrame:
    """The fields with type and description from the schema, and how many rows fill them."""
    counts = clean.agg(*[F.count(f.name).alias(f.name) for f in CLEAN_SCHEMA])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("field"),
            F.lit(f.metadata["label"]).alias("type"),
            F.lit(f.metadata["description"]).alias("description"),
            F.col(f.name).alias("rows_filled"),
        )
        for i, f in enumerate(CLEAN_SCHEMA, start=1)
    ]
    return counts.select(F.inline(F.array(*rows))).orderBy("position")


def export(reports: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Write every named report into its own folder below ``path``, as ``parquet`` or ``csv``."""
    writer = {"parquet": write_table, "csv": write_csv}[fmt]
    for name, df in reports.items():
        writer(df, f"{path}/{name}")
