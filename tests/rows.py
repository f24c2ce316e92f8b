"""Hand-made stage rows."""

from __future__ import annotations

from ticketlens.schema import CLEAN_SCHEMA, STAGE_COLUMNS, STAGE_SCHEMA

GOOD = {
    "ticket_id": "TKT1",
    "customer_id": "CU1",
    "customer_region": "north",
    "agent_id": "AG1",
    "agent_name": "Ann",
    "channel": "Chat",
    "category": "Billing",
    "created_at": "2025-01-05 10:00:00",
    "first_response_minutes": "3.5",
    "resolution_hours": "5.0",
    "csat_score": "4.0",
}


def stage_rows(spark, *changes: dict):
    """One stage row per dict, each a good row with some fields replaced."""
    rows = [tuple({**GOOD, **change}[c] for c in STAGE_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, STAGE_SCHEMA)


def tickets(spark, *changes: dict):
    """Typed rows of the clean shape."""
    from ticketlens.operators.cleaning import typed

    numbered = [{"ticket_id": f"TKT{i}", **c} for i, c in enumerate(changes)]
    return typed(stage_rows(spark, *numbered))


def column(df, name):
    return [r[name] for r in df.collect()]


__all__ = ["CLEAN_SCHEMA", "GOOD", "column", "stage_rows", "tickets"]
