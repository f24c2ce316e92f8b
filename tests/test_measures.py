from datetime import date

import pytest
from pyspark.sql import functions as F
from rows import tickets

from ticketlens.operators import measures
from ticketlens.plans import analysis, reports


def as_dict(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def test_no_late_tickets_leave_the_drop_empty(spark):
    row = measures.evaluate(tickets(spark, {}, {})).first()
    assert row["pct_after_24h"] == 0.0 and row["csat_drop_after_24h"] is None


def test_no_tickets_at_all(spark):
    row = measures.evaluate(tickets(spark, {}).where("1 = 0")).first().asDict()
    assert row.pop("total_tickets") == 0
    assert set(row.values()) == {None}


def test_chosen_measures_and_groups(star):
    df = measures.evaluate(star.tickets, ["avg_csat"], by=("channel", "month"))
    assert df.columns == ["channel", "month", "avg_csat"]


@pytest.mark.parametrize(
    "slicers",
    [
        {"channel": ["HIGH"]},
        {"category": ["LARGE", "SMALL"]},
        {"customer_region": ["Asia"]},
        {"month": [date(1997, 5, 1), date(1998, 2, 1)]},
        {"channel": ["LOW"], "customer_region": ["Europe", "Africa"]},
    ],
)
def test_stored_sums_give_the_same_as_tickets(star, slicers):
    detail = star.detail("customer_region")
    sums = measures.partial_sums(detail)
    for by in ((), ("channel",), ("month", "customer_region")):
        direct = measures.evaluate(detail, by=by, slicers=slicers)
        stored = measures.evaluate_sums(sums, by=by, slicers=slicers)
        assert as_dict(direct, *by) == as_dict(stored, *by)


def test_dimension_slicer_equals_a_column_slicer(star):
    regions = {"customer_region": ["Asia", "Europe"]}
    through = measures.sliced_by_dimension(star.tickets, star.customers, "customer_id", regions)
    direct = measures.evaluate(star.detail("customer_region"), slicers=regions)
    assert measures.evaluate(through).first() == direct.first()


def test_layers_agree(star):
    """The question, the summary and the measure give one and the same number."""
    question = as_dict(analysis.csat_by_bucket(star.tickets), "bucket")
    sheet = [r["avg_csat"] for r in reports.pivot_resolution(star.tickets).collect()]
    measure = measures.evaluate(star.tickets).first()["csat_drop_after_24h"]
    assert sheet[2] == measure
    assert question[("after_24h",)]["pct_lower_vs_within_24h"] == round(100 * measure, 1)
    assert question[("within_24h",)]["avg_csat"] == round(sheet[0], 2)

    shares = as_dict(analysis.channel_share(star.tickets), "channel")
    pivot = as_dict(reports.pivot_channel(star.tickets), "channel")
    assert pivot.pop(("Total",))["tickets"] == star.tickets.count()
    for key, row in shares.items():
        assert pivot[key]["tickets"] == row["tickets"]
        assert abs(100 * pivot[key]["share"] - row["pct_of_tickets"]) <= 0.05 + 1e-9

    months = as_dict(analysis.monthly_volume(star.tickets), "month")
    labels = as_dict(reports.pivot_monthly(star.tickets), "month")
    assert {k[0].strftime("%Y-%m"): v["tickets"] for k, v in months.items()} == {
        k[0]: v["tickets"] for k, v in labels.items()
    }


def test_sums_do_not_depend_on_the_threshold_used_elsewhere(star):
    n = star.tickets.where(F.col("resolution_hours") > 10).count()
    late = measures.grouped(star.tickets, threshold=10).first()["late_tickets"]
    assert late == n
