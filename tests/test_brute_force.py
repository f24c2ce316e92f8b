"""The whole cleaning against a plain Python version of its rules, on random messy rows."""

import random
from collections import Counter
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

import pytest
from rows import CLEAN_SCHEMA
from ticketlens.operators import cleaning
from ticketlens.schema import CHANNELS, REQUIRED_FIELDS, STAGE_COLUMNS, STAGE_SCHEMA


def messy_rows(seed, n=400):
    rng = random.Random(seed)
    pick = rng.choice

    def one():
        ticket = f"TKT{rng.randint(1, n // 3)}"
        return {
            "ticket_id": pick([ticket] * 12 + [f" {ticket}", f"{ticket}  ", None, " "]),
            "customer_id": pick([f"CU{rng.randint(1, 30)}"] * 20 + [None, "CU123456789"]),
            "customer_region": pick([" north ", "SOUTH", "west"] * 8 + ["", None]),
            "agent_id": pick([f"AG{rng.randint(1, 9)}"] * 15 + [None, "", "  "]),
            "agent_name": pick(["Ann Lee", " Bo "] * 10 + [None]),
            "channel": pick([*CHANNELS] * 5 + ["Fax", "chat", None, " Chat"]),
            "category": pick(["Billing", "Refund"] * 10 + ["", "x" * 31]),
            "created_at": pick(
                [f"2025-0{rng.randint(1, 9)}-1{rng.randint(0, 9)} 08:00:00"] * 15 + [None, "soon"]
            ),
            "first_response_minutes": pick(["1.5", "20", "3.25", "0.05"] * 5 + ["", "0", "1e9", "x"]),
            "resolution_hours": pick(["2.0", "24.0", "24.1", "70.55"] * 5 + [None, "-3", "1234567"]),
            "csat_score": pick(["1.0", "2.0", "3.4", "4.5", "5"] * 4 + ["", "6", "0.4", "NaN", "many"]),
        }

    rows = [one() for _ in range(n)]
    return rows + [dict(r) for r in rng.sample(rows, n // 4)]


def number(text, digits, limit):
    try:
        value = Decimal(text.strip())
    except InvalidOperation:
        return None
    if not value.is_finite():
        return None
    value = value.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
    return value if abs(value) < limit else None


def moment(text):
    try:
        return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
    except ValueError:
        return None


def blank(v):
    return v is None or v.strip(" ") == ""


def order(row):
    """Earliest time first, then time text, then all columns; missing values last."""
    ts = None if blank(row["created_at"]) else moment(row["created_at"])
    parts = [ts, row["created_at"], *[row[c] for c in STAGE_COLUMNS if c not in ("ticket_id", "created_at")]]
    return [(v is None, v if v is not None else "") if i else (v is None, v or datetime.min) for i, v in enumerate(parts)]


def convert(row):
    out = {c: row[c].strip(" ") if row[c] is not None else None for c in STAGE_COLUMNS}
    out["customer_region"] = (out["customer_region"] or "").title()
    out["created_at"] = moment(row["created_at"] or "")
    out["first_response_minutes"] = number(row["first_response_minutes"], 1, 10**6)
    out["resolution_hours"] = number(row["resolution_hours"], 1, 10**5)
    score = number(row["csat_score"], 0, 2**15)
    out["csat_score"] = None if score is None else int(score)
    return out


def sound(row):
    v = convert(row)
    if any(blank(row[c]) for c in STAGE_COLUMNS if c not in REQUIRED_FIELDS):
        return False
    if any(v[c] is None for c in ("created_at", "first_response_minutes", "resolution_hours", "csat_score")):
        return False
    lengths = {f.name: f.metadata.get("max_length") for f in CLEAN_SCHEMA}
    if any(n and len(v[c]) > n for c, n in lengths.items()):
        return False
    return (
        v["channel"] in CHANNELS
        and v["first_response_minutes"] > 0
        and v["resolution_hours"] > 0
        and 1 <= v["csat_score"] <= 5
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cleaning(spark, seed):
    raw = messy_rows(seed)
    first, unnamed = {}, []
    for row in raw:
        if blank(row["ticket_id"]):
            unnamed.append(row)
            continue
        key = row["ticket_id"].strip(" ")
        if key not in first or order(row) < order(first[key]):
            first[key] = row
    complete = [r for r in first.values() if not any(blank(r[c]) for c in REQUIRED_FIELDS)]
    good = [convert(r) for r in complete if sound(r)]

    stage = spark.createDataFrame([tuple(r[c] for c in STAGE_COLUMNS) for r in raw], STAGE_SCHEMA)
    cleaned, held = cleaning.clean(stage.repartition(4))
    got = Counter(tuple(r) for r in cleaned.collect())
    assert got == Counter(tuple(r[c] for c in STAGE_COLUMNS) for r in good)
    assert 0 < len(good) < len(complete) < len(first)
    assert held.count() == len(unnamed) + len(complete) - len(good)
    lost = cleaning.incomplete(stage, per="ticket").first()[0]
    assert lost == len(first) - len(complete)
    distinct_gaps = {tuple(r.values()) for r in raw if any(blank(r[c]) for c in REQUIRED_FIELDS)}
    assert cleaning.incomplete(stage).first()[0] == len(distinct_gaps)
