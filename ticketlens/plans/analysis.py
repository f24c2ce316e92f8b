"""The eight standing questions about the tickets, and their uncut forms.

Every question scans the tickets once, reads only its columns, and folds them to groups before
anything else. Windows over all rows appear only on groups by channel, whose domain is fixed, and by
month, whose range is; everything else is ranked in slices or held against one-row totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_of
from ..functions.numeric import exact_ratio, mean, over_groups, percent, ratio
from ..operators.calendar import calendar_of
from ..operators.measures import grouped, regrouped
from ..operators.ranking import rank_entities, tile_sizes, top_ranked
from ..schema import THRESHOLD_HOURS


def _mean(total: str, count: str, digits: int):
    return mean(F.col(total), F.col(count), digits)


def channel_share(tickets: DataFrame) -> DataFrame:
    """Volume, share, satisfaction and first response by channel."""
    groups = grouped(tickets, "channel")
    return groups.select(
        "channel",
        "tickets",
        percent(F.col("tickets"), over_groups(F.sum("tickets"))).alias("pct_of_tickets"),
        _mean("sum_csat", "tickets", 2).alias("avg_csat"),
        _mean("sum_minutes", "tickets", 1).alias("avg_first_response_min"),
    ).orderBy(F.desc_nulls_first("tickets"), "channel")


def csat_by_bucket(tickets: DataFrame, threshold=THRESHOLD_HOURS) -> DataFrame:
    """Satisfaction within and after the threshold, and how much lower it is after.

    Both buckets come out of one aggregate. Without tickets within the threshold there is nothing to
    compare with, and the result is empty.
    """
    total = grouped(tickets, threshold=threshold)
    bucket = [
        F.struct(
            F.lit(label).alias("bucket"),
            F.col(f"{part}_tickets").alias("tickets"),
            F.col(f"{part}_csat").alias("score"),
            F.col("fast_tickets").alias("base_tickets"),
            F.col("fast_csat").alias("base_score"),
        )
        for label, part in ((f"within_{threshold:g}h", "fast"), (f"after_{threshold:g}h", "late"))
    ]
    rows = total.select(F.inline(F.array(*bucket))).where("tickets > 0 AND base_tickets > 0")
    wide = "decimal(38,0)"
    base = F.col("base_score").cast(wide) * F.col("tickets")
    own = F.col("score").cast(wide) * F.col("base_tickets")
    return rows.select(
        "bucket",
        "tickets",
        _mean("score", "tickets", 2).alias("avg_csat"),
        percent(base - own, base).alias(f"pct_lower_vs_within_{threshold:g}h"),
    ).orderBy(F.desc_nulls_first("bucket"))


def _with_change(months: DataFrame, order: str) -> DataFrame:
    earlier = F.lag("tickets").over(Window.orderBy(F.asc_nulls_last(order)))
    change = F.col("tickets") - earlier
    return months.withColumn("mom_change", change).withColumn("mom_pct", percent(change, earlier))


def monthly_volume(tickets: DataFrame) -> DataFrame:
    """Tickets per month that has any, and the change from the month listed before it."""
    months = grouped(tickets, month_of(tickets).alias("month"))
    rows = months.select("month", "tickets", _mean("sum_csat", "tickets", 2).alias("avg_csat"))
    return _with_change(rows, "month").orderBy(F.asc_nulls_last("month"))


def calendar_monthly(tickets: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Tickets per calendar month; months without tickets count 0.

    Tickets are folded to days before they meet the calendar.
    """
    days = calendar_of(tickets) if calendar is None else calendar
    per_day = tickets.groupBy(F.col("created_at").cast("date").alias("date")).agg(
        F.count("*").alias("n")
    )
    filled = days.join(per_day, "date", "left")
    months = filled.groupBy("month").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tickets"))
    return _with_change(months, "month").orderBy("month")


def _agent_scores(tickets: DataFrame, agents: DataFrame) -> DataFrame:
    """Every agent with averages and unrounded satisfaction.

    Tickets are folded by agent before the names are joined, so a busy agent is one row there.
    """
    stats = grouped(tickets, "agent_id").join(agents, "agent_id")
    return stats.select(
        "agent_id",
        "agent_name",
        "tickets",
        _mean("sum_csat", "tickets", 2).alias("avg_csat"),
        _mean("sum_hours", "tickets", 1).alias("avg_resolution_hrs"),
        _mean("sum_minutes", "tickets", 1).alias("avg_frt_min"),
        exact_ratio(F.col("sum_csat"), F.col("tickets")).alias("score"),
    )


_AGENT_RANKS = ("csat_rank", "csat_dense_rank", "csat_quartile")


def agent_ranking(tickets: DataFrame, agents: DataFrame) -> DataFrame:
    """Every agent with averages, rank and quartile by unrounded satisfaction."""
    scored = _agent_scores(tickets, agents)
    ranked = rank_entities(scored, "score", ("agent_id",), 4, _AGENT_RANKS)
    return ranked.drop("score", "csat_dense_rank")


def agent_leaderboard(tickets: DataFrame, agents: DataFrame, n: int = 15) -> DataFrame:
    """The best agents, with their ranks among all; equal ranks are listed by agent id."""
    scored = _agent_scores(tickets, agents)
    best = top_ranked(scored, "score", ("agent_id",), n, 4, _AGENT_RANKS)
    return best.drop("score", "csat_dense_rank").orderBy("csat_rank", "agent_id")


def agent_quartiles(tickets: DataFrame, agents: DataFrame) -> DataFrame:
    """Agents in each quartile of :func:`agent_ranking`, which one count of them says."""
    listed = tickets.select("agent_id").distinct().join(agents, "agent_id")
    return tile_sizes(listed, 4, ("csat_quartile", "agents")).orderBy("csat_quartile")


def customer_ranking(tickets: DataFrame) -> DataFrame:
    """Every customer with rank, dense rank and quartile by unrounded satisfaction."""
    scored = grouped(tickets, "customer_id").select(
        "customer_id",
        "tickets",
        _mean("sum_csat", "tickets", 2).alias("avg_csat"),
        exact_ratio(F.col("sum_csat"), F.col("tickets")).alias("score"),
    )
    names = ("csat_rank", "csat_dense_rank", "csat_quartile")
    return rank_entities(scored, "score", ("customer_id",), 4, names).drop("score")


def top_categories_per_channel(tickets: DataFrame, k: int = 2) -> DataFrame:
    """The most frequent categories of every channel; equal counts are listed by category."""
    groups = grouped(tickets, "channel", "category")
    order = Window.partitionBy("channel").orderBy(F.desc_nulls_first("tickets"), "category")
    ranked = groups.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k)
    return ranked.orderBy("channel", "rn").select(
        "channel",
        "category",
        "tickets",
        _mean("sum_csat", "tickets", 2).alias("avg_csat"),
        _mean("sum_hours", "tickets", 1).alias("avg_resolution_hrs"),
    )


def sla_breach(tickets: DataFrame, threshold=THRESHOLD_HOURS) -> DataFrame:
    """Late share by category. The rank compares exact shares, not rounded percents."""
    scored = grouped(tickets, "category", threshold=threshold).select(
        "category",
        "tickets",
        "late_tickets",
        percent(F.col("late_tickets"), F.col("tickets")).alias("pct_late"),
        _mean("sum_csat", "tickets", 2).alias("avg_csat"),
        exact_ratio(F.col("late_tickets"), F.col("tickets")).alias("score"),
    )
    names = ("plain_rank", "lateness_rank", "tile")
    ranked = rank_entities(scored, "score", ("category",), 1, names)
    return ranked.drop("score", "plain_rank", "tile").orderBy("lateness_rank", "category")


def regional_csat(tickets: DataFrame, customers: DataFrame) -> DataFrame:
    """Satisfaction by region against the plain mean of regions and against all tickets.

    Tickets are folded by customer before the join, and the company's mean is added up from the same
    groups, tickets without a known customer included.
    """
    known = customers.select("customer_id", "customer_region", F.lit(True).alias("known"))
    per_customer = grouped(tickets, "customer_id").join(known, "customer_id", "left")
    regions = regrouped(per_customer, "known", "customer_region")
    own = exact_ratio(F.col("sum_csat"), F.col("tickets"))
    # one row of totals; a window over all regions would bring them into one task
    totals = regions.agg(
        F.struct(
            F.avg(F.when(F.col("known"), own)).alias("region_mean"),
            F.sum("tickets").alias("all_tickets"),
            F.sum("sum_csat").alias("all_csat"),
        )
    ).scalar()
    wide = "decimal(38,0)"
    n, all_n = F.col("tickets").cast(wide), F.col("all_tickets").cast(wide)
    gap = F.col("sum_csat").cast(wide) * all_n - F.col("all_csat").cast(wide) * n
    listed = regions.where("known").select(
        "*",
        totals["region_mean"].alias("region_mean"),
        totals["all_tickets"].alias("all_tickets"),
        totals["all_csat"].alias("all_csat"),
    )
    return listed.select(
        "customer_region",
        "tickets",
        _mean("sum_csat", "tickets", 2).alias("region_csat"),
        F.round("region_mean", 2).cast("double").alias("avg_of_region_csat"),
        ratio(gap, n * all_n, 3).alias("diff_vs_company"),
    ).orderBy(F.desc_nulls_first("region_csat"), "customer_region")


def channel_bucket_matrix(tickets: DataFrame, threshold=THRESHOLD_HOURS) -> DataFrame:
    """Satisfaction by channel within and after the threshold; NULL where a cell has no tickets."""
    return grouped(tickets, "channel", threshold=threshold).select(
        "channel",
        _mean("fast_csat", "fast_tickets", 2).alias(f"csat_within_{threshold:g}h"),
        _mean("late_csat", "late_tickets", 2).alias(f"csat_after_{threshold:g}h"),
    ).orderBy(F.asc_nulls_last("channel"))
