"""Named measures that can be sliced, grouped, and rebuilt from stored partial sums.

Only sums and counts are kept, never averages, so any slice of stored sums gives the same result as
the tickets themselves.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_of, period_of
from ..functions.numeric import plain_ratio
from ..schema import THRESHOLD_HOURS


def parts(threshold=THRESHOLD_HOURS) -> dict[str, Column]:
    """Additive parts of every measure. Spark computes only those a query goes on to use."""
    late = F.col("resolution_hours") > threshold
    fast = F.col("resolution_hours") <= threshold
    score = F.col("csat_score")
    return {
        "tickets": F.count("*"),
        "sum_csat": F.sum(score),
        "sum_hours": F.sum("resolution_hours"),
        "sum_minutes": F.sum("first_response_minutes"),
        "late_tickets": F.count_if(late),
        "late_csat": F.sum(F.when(late, score)),
        "fast_tickets": F.count_if(fast),
        "fast_csat": F.sum(F.when(fast, score)),
    }


PART_NAMES = (
    "tickets",
    "sum_csat",
    "sum_hours",
    "sum_minutes",
    "late_tickets",
    "late_csat",
    "fast_tickets",
    "fast_csat",
)


def grouped(df: DataFrame, *by, threshold=THRESHOLD_HOURS) -> DataFrame:
    """One pass over tickets: the parts for every group."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in parts(threshold).items()])


def regrouped(sums: DataFrame, *by) -> DataFrame:
    """Add up stored parts to coarser groups."""
    return sums.groupBy(*by).agg(*[F.sum(n).alias(n) for n in PART_NAMES])


def _mean(total: str, count: str) -> Column:
    return plain_ratio(F.col(total), F.col(count))


def _drop() -> Column:
    within, after = _mean("fast_csat", "fast_tickets"), _mean("late_csat", "late_tickets")
    return F.try_divide(within - after, within)


PERIODS = ("month", "quarter", "year")


def measures(threshold=THRESHOLD_HOURS) -> dict[str, Column]:
    """Every measure, written in terms of the parts. Empty divisors give NULL."""
    return {
        "total_tickets": F.coalesce(F.col("tickets"), F.lit(0)),
        "avg_csat": _mean("sum_csat", "tickets"),
        "avg_resolution_hours": _mean("sum_hours", "tickets"),
        "avg_first_response_min": _mean("sum_minutes", "tickets"),
        f"pct_after_{threshold:g}h": _mean("late_tickets", "tickets"),
        f"csat_drop_after_{threshold:g}h": _drop(),
    }


def sliced(df: DataFrame, slicers: Mapping | None) -> DataFrame:
    """Keep the rows whose columns hold one of the chosen values.

    ``month`` and ``quarter`` take their first days, ``year`` a number.
    """
    if not slicers:
        return df
    tests = [
        (period_of(df, name) if name in PERIODS else F.col(name)).isin(*chosen)
        for name, chosen in slicers.items()
    ]
    return df.where(reduce(and_, tests))


def sliced_by_dimension(df: DataFrame, dimension: DataFrame, key: str, slicers: Mapping) -> DataFrame:
    """Let a filter on a dimension reach the fact. The dimension adds no columns and no rows."""
    return df.join(sliced(dimension, slicers).select(key), key, "left_semi")


def _chosen(sums: DataFrame, names, by, threshold) -> DataFrame:
    known = measures(threshold)
    picked = list(known) if names is None else list(names)
    return sums.select(*by, *[known[m].alias(m) for m in picked])


def evaluate(
    df: DataFrame, names=None, by=(), slicers: Mapping | None = None, threshold=THRESHOLD_HOURS
) -> DataFrame:
    """Measures of the sliced tickets for every group; one row when ``by`` is empty.

    ``by`` may name ``month``, ``quarter`` and ``year`` besides the table's own columns.
    """
    rows = sliced(df, slicers)
    for name in PERIODS:
        if name in by:
            rows = rows.withColumn(name, period_of(rows, name))
    return _chosen(grouped(rows, *by, threshold=threshold), names, by, threshold)


def partial_sums(
    df: DataFrame,
    dims=("month", "channel", "category", "customer_region", "agent_id"),
    threshold=THRESHOLD_HOURS,
) -> DataFrame:
    """The parts for every combination of the dimensions, to be stored and added up later."""
    rows = df.withColumn("month", month_of(df)) if "month" in dims else df
    return grouped(rows, *dims, threshold=threshold)


def evaluate_sums(
    sums: DataFrame, names=None, by=(), slicers: Mapping | None = None, threshold=THRESHOLD_HOURS
) -> DataFrame:
    """The same as :func:`evaluate`, from stored partial sums of that threshold."""
    chosen = sums
    if slicers:
        tests = [F.col(name).isin(*values) for name, values in slicers.items()]
        chosen = sums.where(reduce(and_, tests))
    return _chosen(regrouped(chosen, *by), names, by, threshold)
