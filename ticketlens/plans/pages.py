"""The report pages and the workbook as named datasets. Drawing them is left to other tools."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..functions.dates import MONTH
from ..operators import measures
from ..operators.model import Star
from ..schema import STAGE_COLUMNS
from . import analysis, reports

Datasets = dict[str, DataFrame]


def sliced_tickets(star: Star, slicers: Mapping | None = None) -> DataFrame:
    """Tickets under any of the slicers ``channel``, ``category``, ``customer_region``, ``month``.

    The region is an attribute of the customer, so its filter reaches the tickets by a semi-join.
    """
    own = {k: v for k, v in (slicers or {}).items() if k != "customer_region"}
    region = {k: v for k, v in (slicers or {}).items() if k == "customer_region"}
    rows = measures.sliced(star.tickets, own)
    if region:
        rows = measures.sliced_by_dimension(rows, star.customers, "customer_id", region)
    return rows


def overview(star: Star, slicers: Mapping | None = None) -> Datasets:
    rows = sliced_tickets(star, slicers)
    return {
        "cards": measures.evaluate(rows),
        "monthly_trend": analysis.monthly_volume(rows),
        "csat_by_bucket": analysis.csat_by_bucket(rows),
        "tickets_by_channel": analysis.channel_share(rows),
        "tickets_by_category": reports.pivot_category(rows),
    }


def channel_and_category(star: Star, slicers: Mapping | None = None) -> Datasets:
    rows = sliced_tickets(star, slicers)
    return {
        "top_categories": analysis.top_categories_per_channel(rows),
        "sla_breach": analysis.sla_breach(rows),
        "regional_csat": analysis.regional_csat(rows, star.customers),
        "channel_bucket_matrix": analysis.channel_bucket_matrix(rows),
    }


def agent_performance(star: Star) -> Datasets:
    """All agents, not only the leaders."""
    return {
        "leaderboard": analysis.agent_ranking(star.tickets, star.agents),
        "quartiles": analysis.agent_quartiles(star.tickets, star.agents),
    }


def workbook(star: Star, agent_id: str | None = None) -> Datasets:
    """One dataset per sheet; the lookup opens with the agent of the first ticket."""
    chosen = reports.first_agent(star.tickets) if agent_id is None else agent_id
    return {
        "raw_data": star.stage.select(*STAGE_COLUMNS),
        "clean_data": star.clean.drop(MONTH),
        "data_dictionary": reports.data_dictionary(star.clean),
        "by_channel": reports.pivot_channel(star.tickets),
        "by_category": reports.pivot_category(star.tickets),
        "by_resolution": reports.pivot_resolution(star.tickets),
        "by_month": reports.pivot_monthly(star.tickets),
        "agent_lookup": reports.agent_scorecard(star.tickets, star.agents, chosen),
        "insights": reports.insights(star.tickets),
    }
