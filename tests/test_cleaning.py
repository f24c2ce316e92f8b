from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import column, stage_rows

from ticketlens.operators import cleaning, quality
from ticketlens.schema import STAGE_COLUMNS, Rules


def problems(spark, *changes):
    held = cleaning.quarantine(stage_rows(spark, *changes))
    return {r["ticket_id"]: r["problems"] for r in held.collect()}


def test_padded_ids_are_one_ticket(spark):
    stage = stage_rows(spark, {"ticket_id": "TKT1"}, {"ticket_id": " TKT1 "})
    assert column(cleaning.clean_tickets(stage), "ticket_id") == ["TKT1"]


def test_equal_times_keep_the_lower_tiebreak(spark):
    copies = [{"csat_score": "5.0"}, {"csat_score": "2.0"}, {"csat_score": "3.0"}]
    for order in (copies, copies[::-1]):
        kept = cleaning.clean_tickets(stage_rows(spark, *order).repartition(3))
        assert column(kept, "csat_score") == [2]


def test_earliest_copy_is_kept_by_time_not_by_text(spark):
    stage = stage_rows(
        spark,
        {"created_at": "2025-01-10 00:00:00", "csat_score": "5"},
        {"created_at": "2025-1-9", "csat_score": "1"},
    )
    kept = cleaning.clean_tickets(stage).first()
    assert (kept["created_at"], kept["csat_score"]) == (datetime(2025, 1, 9), 1)


def test_incomplete_first_copy_loses_the_ticket(spark):
    stage = stage_rows(
        spark,
        {"created_at": "2025-01-01 00:00:00", "agent_id": " "},
        {"created_at": "2025-01-02 00:00:00"},
    )
    assert cleaning.clean_tickets(stage).isEmpty()
    assert cleaning.quarantine(stage).isEmpty()
    assert column(cleaning.incomplete(stage, per="ticket"), "incomplete_tickets") == [1]


def test_rows_without_id_are_duplicates_in_the_profile_and_quarantined(spark):
    stage = stage_rows(spark, {}, {"ticket_id": None}, {"ticket_id": None})
    row = quality.profile(stage).first()
    assert row.asDict() == {
        "raw_rows": 3,
        "distinct_ids": 1,
        "duplicate_rows": 2,
        "exact_duplicates": 1,
    }
    held = cleaning.quarantine(stage)
    assert column(held, "problems") == ["ticket_id: blank"] * 2


@pytest.mark.parametrize(
    ("text", "score"), [("4.0", 4), ("4.5", 5), ("4.45", 4), (" 4.0 ", 4), ("1", 1), ("0.5", 1)]
)
def test_scores_round_half_up_once(spark, text, score):
    assert column(cleaning.clean_tickets(stage_rows(spark, {"csat_score": text})), "csat_score") == [
        score
    ]


def test_bad_scores(spark):
    found = problems(
        spark,
        {"ticket_id": "a", "csat_score": "6"},
        {"ticket_id": "b", "csat_score": "0"},
        {"ticket_id": "c", "csat_score": "abc"},
        {"ticket_id": "d", "csat_score": "NaN"},
        {"ticket_id": "e", "csat_score": "100000"},
        {"ticket_id": "f", "csat_score": "-1"},
    )
    assert found == {
        "a": "csat_score: range",
        "b": "csat_score: range",
        "c": "csat_score: cast",
        "d": "csat_score: cast",
        "e": "csat_score: cast",
        "f": "csat_score: range",
    }


def test_numbers_round_to_one_digit(spark):
    row = cleaning.clean_tickets(stage_rows(spark, {"resolution_hours": "12.25"})).first()
    assert row["resolution_hours"] == Decimal("12.3")


def test_other_problems(spark):
    found = problems(
        spark,
        {"ticket_id": "a", "first_response_minutes": "12345678"},
        {"ticket_id": "b", "customer_region": None},
        {"ticket_id": "c", "category": " "},
        {"ticket_id": "d", "created_at": None},
        {"ticket_id": "e", "created_at": "soon"},
        {"ticket_id": "f", "channel": "Fax"},
        {"ticket_id": "g", "customer_id": "CU123456789"},
        {"ticket_id": "h", "resolution_hours": "0.0"},
        {"ticket_id": "i", "channel": "Fax", "csat_score": "9"},
    )
    assert found == {
        "a": "first_response_minutes: cast",
        "b": "customer_region: blank",
        "c": "category: blank",
        "d": "created_at: blank",
        "e": "created_at: cast",
        "f": "channel: domain",
        "g": "customer_id: length",
        "h": "resolution_hours: range",
        "i": "channel: domain; csat_score: range",
    }


def test_a_tab_is_not_blank(spark):
    stage = stage_rows(spark, {"agent_id": "\t"})
    assert column(cleaning.clean_tickets(stage), "agent_id") == ["\t"]
    assert column(cleaning.incomplete(stage), "incomplete_rows") == [0]


@pytest.mark.parametrize(
    ("text", "region"),
    [("  north ", "North"), ("NORTH", "North"), ("middle east", "Middle East"), ("north-east", "North-East"), ("o'neil 2ND", "O'Neil 2nd")],
)
def test_region_is_trimmed_and_capitalised(spark, text, region):
    stage = stage_rows(spark, {"customer_region": text})
    assert column(cleaning.clean_tickets(stage), "customer_region") == [region]


def test_strict_raises_only_when_something_is_held(spark):
    good = stage_rows(spark, {})
    assert cleaning.clean(good, strict=True)[0].count() == 1
    with pytest.raises(ValueError, match="quarantine"):
        cleaning.clean(stage_rows(spark, {"channel": "Fax"}), strict=True)


def test_strict_clean_drops_any_gap_and_whole_row_copies(spark):
    stage = stage_rows(spark, {}, {}, {"csat_score": "3.0"}, {"category": ""}, {"customer_id": None})
    assert sorted(column(cleaning.strict_clean(stage), "csat_score")) == [3, 4]


def test_every_raw_row_is_accounted_for(spark):
    stage = stage_rows(
        spark,
        {},
        {},
        {"ticket_id": " TKT1"},
        {"ticket_id": "TKT2", "agent_id": ""},
        {"ticket_id": "TKT3", "channel": "Fax"},
        {"ticket_id": "  "},
        {"ticket_id": "TKT4"},
    )
    good, held = cleaning.clean(stage)
    lost = cleaning.incomplete(stage, per="ticket").first()[0]
    named = stage.where(F.trim("ticket_id") != "").select(F.trim("ticket_id"))
    copies = named.count() - named.distinct().count()
    assert good.count() + held.count() + lost + copies == stage.count() == 7


def test_cleaning_ignores_row_order_partitions_and_added_copies(spark, star):
    import __spark_entry__ as entry

    def cleaned(stage):
        rows = cleaning.clean_tickets(stage, entry.driver.RULES, entry.driver.TIEBREAK)
        return rows.exceptAll(expected).count(), expected.exceptAll(rows).count()

    expected = star.clean.drop("created_month")
    assert cleaned(star.stage.repartition(5)) == (0, 0)
    assert cleaned(star.stage.unionByName(star.stage.sample(0.3, 1))) == (0, 0)


def test_dedupe_is_idempotent(spark, star):
    import __spark_entry__ as entry

    once = cleaning.dedupe_tickets(star.stage, entry.driver.TIEBREAK)
    twice = cleaning.dedupe_tickets(once, entry.driver.TIEBREAK)
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


@pytest.mark.parametrize("gap", [None, "", "  "])
def test_required_fields_are_a_parameter(spark, gap):
    """A gap in a field that is not required for completeness is a broken rule instead."""
    stage = stage_rows(
        spark,
        {"agent_id": gap},
        {"ticket_id": "TKT2"},
        {"ticket_id": "TKT3", "csat_score": gap},
        {"ticket_id": "TKT4", "channel": gap},
    )
    loose = Rules(required=("channel",))
    good, found = cleaning.clean(stage, loose)
    assert sorted(column(found, "problems")) == ["agent_id: blank", "csat_score: blank"]
    assert column(good, "ticket_id") == ["TKT2"]
    assert set(found.columns) == {*STAGE_COLUMNS, "problems"}
