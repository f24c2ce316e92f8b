from rows import column, tickets

from ticketlens.operators import model
from ticketlens.plans import reports


def test_total_row_is_last_and_holds_the_count(spark):
    rows = tickets(spark, {"channel": "Phone"}, {"channel": "Chat"}, {"channel": "Chat"})
    got = [tuple(r) for r in reports.pivot_channel(rows).collect()]
    assert [g[0] for g in got] == ["Chat", "Phone", "Total"]
    assert got[0][1:3] == (2, 2 / 3)
    assert got[2][1:] == (3, None, None, None)


def test_categories_by_falling_volume(spark):
    rows = tickets(spark, {"category": "B"}, {"category": "A"}, {"category": "C"}, {"category": "C"})
    assert column(reports.pivot_category(rows), "category") == ["C", "A", "B"]


def test_resolution_rows_are_always_there(spark):
    got = [tuple(r) for r in reports.pivot_resolution(tickets(spark, {})).collect()]
    assert got == [
        ("Within 24h (<=24)", 1, 4.0),
        ("After 24h (>24)", 0, None),
        ("CSAT drop after 24h", None, None),
    ]


def test_scorecard(spark):
    clean = tickets(spark, {"csat_score": "5"}, {"csat_score": "4"}, {"agent_id": "AG2", "agent_name": "Bo"})
    rows, staff = model.tickets(clean), model.agents(clean)
    card = reports.agent_scorecard(rows, staff, "AG1").first()
    assert (card["agent_name"], card["tickets"], card["avg_csat"]) == ("Ann", 2, 4.5)
    assert reports.agent_scorecard(rows, staff, "AG77").isEmpty()
    # Keys match exactly, not ignoring case.
    assert reports.agent_scorecard(rows, staff, "ag1").isEmpty()
    assert reports.agent_scorecard(rows, staff, reports.first_agent(rows)).first()["agent_id"] == "AG1"


def test_insights_name_the_largest_channel_not_the_first(spark):
    rows = tickets(
        spark,
        {"channel": "Chat", "first_response_minutes": "90"},
        {"channel": "Phone", "resolution_hours": "30", "csat_score": "3", "category": "Refund"},
        {"channel": "Phone", "category": "Delivery"},
    )
    assert column(reports.insights(rows), "insight") == [
        "Phone brings the most tickets: 66.7% of them.",
        "Beyond 24 hours satisfaction is 3.00, up to then 4.00: 25.0% less.",
        "Speed up Refund and Billing tickets, which pass 24 hours most often, and Chat, the channel"
        " slowest to respond.",
    ]


def test_insights_always_have_three_lines(spark):
    early = tickets(spark, {"resolution_hours": "2"})
    lines = column(reports.insights(early, threshold=12), "insight")
    assert len(lines) == 3 and lines[1] == "There are not tickets on both sides of 12 hours to compare."
    assert len(column(reports.insights(early.limit(0)), "insight")) == 3


def test_labels_follow_the_threshold(spark):
    rows = tickets(spark, {"resolution_hours": "30"})
    labels = column(reports.pivot_resolution(rows, threshold=48), "resolution_bucket")
    assert labels == ["Within 48h (<=48)", "After 48h (>48)", "CSAT drop after 48h"]


def test_dictionary_lists_all_fields(star):
    rows = reports.data_dictionary(star.clean).collect()
    assert [r["position"] for r in rows] == list(range(1, 12))
    assert {r["rows_filled"] for r in rows} == {star.clean.count()}
    assert all(r["description"] for r in rows)
