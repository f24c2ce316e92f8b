import pytest
from rows import stage_rows, tickets

from ticketlens.operators import model, quality
from ticketlens.schema import Range
from ticketlens.sources.shared import SharedTables


def counts(df):
    return {r["column"]: r["bad_rows"] for r in df.collect()}


def test_unique(spark):
    stage = stage_rows(spark, {"ticket_id": "a"}, {"ticket_id": "a"}, {"ticket_id": "b"})
    assert counts(quality.check_unique({"t": (stage, "ticket_id")})) == {"t": 1}


def test_not_null_counts_blank_text(spark):
    stage = stage_rows(spark, {"category": " "}, {"category": None}, {"agent_id": "\t"})
    found = counts(quality.check_not_null(stage))
    assert found["category"] == 2 and found["agent_id"] == 0 and len(found) == 11


def test_domain_and_range(spark):
    stage = stage_rows(spark, {"channel": "Fax"}, {"csat_score": "6"}, {"resolution_hours": "-1"})
    assert counts(quality.check_domain(stage)) == {"channel": 1}
    assert counts(quality.check_range(stage)) == {
        "first_response_minutes > 0": 0,
        "resolution_hours > 0": 1,
        "csat_score between 1 and 5": 1,
        "created_at between 1900-01-01 and 2199-12-31": 0,
    }
    several = quality.check_range(stage, {"csat_score": [Range(1, 5), Range(5, 6)]})
    assert counts(several) == {"csat_score between 1 and 5": 1, "csat_score between 5 and 6": 2}


def test_castable(spark):
    stage = stage_rows(
        spark, {"csat_score": "x"}, {"created_at": "soon"}, {"customer_id": "C" * 11}, {"csat_score": ""}
    )
    found = {k: v for k, v in counts(quality.check_castable(stage)).items() if v}
    assert found == {"csat_score": 1, "created_at": 1, "customer_id": 1}


def test_dimension_conflicts(spark):
    stage = stage_rows(spark, {"agent_name": "Ann"}, {"agent_name": "Bob"}, {"agent_id": "AG2"})
    pairs = [("agent_id", "agent_name"), ("customer_id", "customer_region")]
    assert counts(quality.check_dim_conflicts(stage, pairs)) == {
        "agent_id -> agent_name": 1,
        "customer_id -> customer_region": 0,
    }


def test_conflicting_dimension_stops_the_load(spark):
    stage = stage_rows(
        spark, {"ticket_id": "a", "agent_name": "Ann"}, {"ticket_id": "b", "agent_name": "Bob"}
    )
    with pytest.raises(ValueError, match="agent_id"):
        model.Star(SharedTables(spark, "conflict"), lambda: stage).load()


def test_orphans_count_a_row_once(spark):
    clean = tickets(
        spark,
        {},
        {"customer_id": "CU9"},
        {"agent_id": "AG9"},
        {"customer_id": "CU9", "agent_id": "AG9"},
    )
    known = clean.where("customer_id = 'CU1' AND agent_id = 'AG1'")
    customers, agents, rows = model.customers(known), model.agents(known), model.tickets(clean)
    assert quality.orphans(rows, customers, agents).first()[0] == 3
    assert quality.orphans(known, customers, agents).first()[0] == 0
    # The detail drops what has no match, the wide form keeps it.
    assert model.detail(rows, customers, agents).count() == 1
    assert model.widen(rows, customers, agents).where("agent_name IS NULL").count() == 2


def test_reconcile(spark, star):
    row = quality.reconcile(star.stage, star.tickets, star.customers, star.agents).first()
    assert row["raw_rows"] - row["clean_rows"] == row["total_removed"]
    assert row["customers"] == star.customers.count()
