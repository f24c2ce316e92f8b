import random
from collections import defaultdict
from datetime import date
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from rows import column, tickets

from ticketlens.functions import numeric
from ticketlens.operators import calendar, measures, model
from ticketlens.plans import analysis


def rounded(value: Fraction, digits: int) -> float:
    size = abs(value) * 10**digits
    units = (2 * size.numerator + size.denominator) // (2 * size.denominator)
    return (-1 if value < 0 else 1) * units / 10**digits


def test_ratio_rounds_half_away_from_zero(spark):
    cases = [(2345, 1000, 2), (-145, 10000, 3), (1, 3, 2), (-1, 3, 2), (0, 7, 1), (5, 10, 0)]
    cases += [(2344999999999, 10**12, 2), (-1, 1000, 2)]
    random.seed(3)
    cases += [(random.randint(-9999, 9999), random.randint(1, 999), 2) for _ in range(100)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, n long, d long, g int")
    for digits in sorted({c[2] for c in cases}):
        got = df.where(f"g = {digits}").select("i", numeric.ratio(F.col("n"), F.col("d"), digits))
        for i, value in got.collect():
            assert value == rounded(Fraction(cases[i][0], cases[i][1]), digits), cases[i]


def test_ratio_of_nothing_is_null(spark):
    row = spark.range(1).select(
        numeric.ratio(F.lit(1), F.lit(0), 1),
        numeric.plain_ratio(F.lit(1), F.lit(0)),
        numeric.mean(F.lit(None).cast("bigint"), F.lit(0), 2),
    )
    assert list(row.first()) == [None, None, None]


def test_average_on_a_tie(spark):
    # 2.345 on average: seven of 3, and the rest 2, over 20 rows is 2.35; scale it to a true tie.
    scores = ["3.0"] * 69 + ["2.0"] * 131
    rows = tickets(spark, *[{"csat_score": s} for s in scores])
    assert column(analysis.channel_share(rows), "avg_csat") == [2.35]


def test_threshold_is_strict(spark):
    rows = tickets(
        spark,
        {"resolution_hours": "24.0", "csat_score": "4"},
        {"resolution_hours": "24.1", "csat_score": "2"},
    )
    got = {r["bucket"]: tuple(r)[1:] for r in analysis.csat_by_bucket(rows).collect()}
    assert got == {"within_24h": (1, 4.0, 0.0), "after_24h": (1, 2.0, 50.0)}
    buckets = rows.select(model.resolution_bucket().alias("b"))
    assert column(buckets, "b") == ["<= 24 hrs", "> 24 hrs"]
    assert [r["tickets"] for r in analysis.csat_by_bucket(rows, 30).collect()] == [2]


def test_no_base_bucket_gives_no_rows(spark):
    late = tickets(spark, {"resolution_hours": "30.0"})
    assert analysis.csat_by_bucket(late).isEmpty()
    only_fast = tickets(spark, {})
    assert column(analysis.csat_by_bucket(only_fast), "bucket") == ["within_24h"]
    matrix = analysis.channel_bucket_matrix(only_fast).first()
    assert (matrix["csat_within_24h"], matrix["csat_after_24h"]) == (4.0, None)


def test_month_gaps(spark):
    rows = tickets(
        spark,
        {"created_at": "2025-01-05 00:00:00"},
        {"created_at": "2025-01-31 23:59:59"},
        {"created_at": "2025-03-01 00:00:00"},
    )
    volume = [tuple(r) for r in analysis.monthly_volume(rows).collect()]
    assert volume == [
        (date(2025, 1, 1), 2, 4.0, None, None),
        (date(2025, 3, 1), 1, 4.0, -1, -50.0),
    ]
    year = calendar.calendar(spark, date(2025, 1, 1), date(2025, 4, 30))
    filled = [tuple(r) for r in analysis.calendar_monthly(rows, year).collect()]
    assert filled == [
        (date(2025, 1, 1), 2, None, None),
        (date(2025, 2, 1), 0, -2, -100.0),
        (date(2025, 3, 1), 1, 1, None),
        (date(2025, 4, 1), 0, -1, -100.0),
    ]
    assert analysis.calendar_monthly(rows).count() == 12


def test_calendar_has_every_day(spark):
    days = calendar.calendar(spark, date(2024, 1, 1), date(2024, 12, 31)).collect()
    assert len(days) == 366
    leap = [r for r in days if r["date"] == date(2024, 2, 29)][0]
    assert (leap["quarter"], leap["month"], leap["month_label"]) == (1, date(2024, 2, 1), "2024-02")


def test_equal_late_shares_rank_equal(spark):
    def of(category, late, fast):
        return [{"category": category, "resolution_hours": "30"}] * late + [{"category": category}] * fast

    rows = tickets(spark, *of("A", 1, 1), *of("B", 2, 2), *of("C", 0, 3), *of("D", 1, 2))
    got = {r["category"]: r["lateness_rank"] for r in analysis.sla_breach(rows).collect()}
    assert got == {"A": 1, "B": 1, "D": 2, "C": 3}


def _agents(spark, scores):
    rows = tickets(
        spark, *[{"agent_id": f"AG{i:02d}", "agent_name": f"N{i}", "csat_score": s} for i, s in scores]
    )
    return rows, model.agents(rows)


def test_leaderboard_cuts_a_tie_by_agent_id(spark):
    scores = [(i, "5") for i in range(14)] + [(15, "3"), (14, "3")]
    board = analysis.agent_leaderboard(*_agents(spark, scores)).collect()
    assert len(board) == 15
    assert (board[-1]["agent_id"], board[-1]["csat_rank"]) == ("AG14", 15)


@pytest.mark.parametrize(("agents", "sizes"), [(5, [2, 1, 1, 1]), (2, [1, 1]), (9, [3, 2, 2, 2])])
def test_quartile_sizes(spark, agents, sizes):
    rows, staff = _agents(spark, [(i, "4") for i in range(agents)])
    got = [(r["csat_quartile"], r["agents"]) for r in analysis.agent_quartiles(rows, staff).collect()]
    assert got == list(enumerate(sizes, start=1))


def test_top_categories_ties_and_k(spark):
    rows = tickets(
        spark,
        *[{"category": c} for c in ("B", "A", "C", "C")],
        {"channel": "Phone", "category": "Z"},
    )
    top = [tuple(r)[:3] for r in analysis.top_categories_per_channel(rows).collect()]
    assert top == [("Chat", "C", 2), ("Chat", "A", 1), ("Phone", "Z", 1)]
    assert analysis.top_categories_per_channel(rows, 1).count() == 2


def test_regions_against_exact_arithmetic(spark):
    random.seed(5)
    changes = [
        {
            "customer_id": f"CU{random.randint(0, 30)}",
            "csat_score": str(random.randint(1, 5)),
        }
        for _ in range(400)
    ]
    for c in changes:
        c["customer_region"] = ("north", "south", "west")[int(c["customer_id"][2:]) % 3]
    clean = tickets(spark, *changes)
    rows = model.tickets(clean)
    # Customer 0 is unknown: its tickets count for the company, not for a region.
    known = model.customers(clean).where("customer_id <> 'CU0'")
    groups, every = defaultdict(list), [int(c["csat_score"]) for c in changes]
    for c in changes:
        if c["customer_id"] != "CU0":
            groups[c["customer_region"].title()].append(int(c["csat_score"]))
    company = Fraction(sum(every), len(every))
    means = {g: Fraction(sum(s), len(s)) for g, s in groups.items()}
    overall = sum(means.values()) / len(means)
    for r in analysis.regional_csat(rows, known).collect():
        own = means[r["customer_region"]]
        assert r["tickets"] == len(groups[r["customer_region"]])
        assert r["region_csat"] == rounded(own, 2)
        assert r["diff_vs_company"] == rounded(own - company, 3)
        expected = Decimal(overall.numerator) / Decimal(overall.denominator)
        assert r["avg_of_region_csat"] == float(expected.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_planted_headline(spark):
    """Group sizes and sums published for the model data give its published headline values."""
    groups = [  # channel, hours, tickets, score sum: all within / after the threshold
        ("Chat", "5.0", 3000, 12102),
        ("Chat", "30.0", 385, 1116),
        ("Email", "5.0", 4700, 18960),
        ("Email", "30.0", 1785, 5177),
    ]
    frames = []
    for channel, hours, n, total in groups:
        low, extra = divmod(total, n)
        score = F.when(F.col("id") < extra, low + 1).otherwise(low)
        frames.append(
            spark.range(n).select(
                F.lit(channel).alias("channel"),
                F.lit(hours).cast("decimal(6,1)").alias("resolution_hours"),
                F.lit("1.0").cast("decimal(7,1)").alias("first_response_minutes"),
                score.cast("smallint").alias("csat_score"),
            )
        )
    rows = frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])
    assert rows.count() == 9870
    share = {r["channel"]: r["pct_of_tickets"] for r in analysis.channel_share(rows).collect()}
    assert share["Chat"] == 34.3
    buckets = {r["bucket"]: tuple(r)[1:] for r in analysis.csat_by_bucket(rows).collect()}
    assert buckets == {"within_24h": (7700, 4.03, 0.0), "after_24h": (2170, 2.90, 28.1)}
    total = measures.evaluate(rows).first()
    assert total["total_tickets"] == 9870
    assert round(total["avg_csat"], 2) == 3.78
    assert round(total["pct_after_24h"], 3) == 0.220
    assert round(total["csat_drop_after_24h"], 3) == 0.281


def test_shares_add_up(star):
    total = sum(column(analysis.channel_share(star.tickets), "pct_of_tickets"))
    assert abs(total - 100) <= 0.05 * 5
