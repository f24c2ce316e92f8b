"""Rows that occur once are told apart from the others."""

from plans import plan_of
from pyspark.sql import functions as F

from rows import GOOD, stage_rows
from ticketlens.operators import cleaning, repeats
from ticketlens.schema import STAGE_COLUMNS


def numbered(spark, n: int, copies: int):
    """Rows with a key of their own, and the first of them again."""
    ids = spark.range(n).unionByName(spark.range(copies))
    return ids.select(F.concat(F.lit("K"), "id").alias("k"), F.monotonically_increasing_id().alias("row"))


def test_only_repeated_keys_are_looked_at_again(spark):
    rows = numbered(spark, 5000, 40)
    single, again = repeats.split_repeated(rows, "k")
    assert again.count() == 80 and single.count() == 4960
    assert single.unionByName(again).exceptAll(rows).isEmpty()


def test_missing_keys_are_copies_of_each_other(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", None)], "k string, v int")
    single, again = repeats.split_repeated(rows, "k")
    assert sorted(r["k"] for r in single.collect()) == ["a", "b"]
    assert [r["k"] for r in again.collect()] == [None, None]
    assert repeats.split_repeated(rows, "k", "v")[1].isEmpty()
    assert repeats.split_repeated(rows.where("false"), "k")[0].isEmpty()


def test_shared_bits_cost_rows_but_lose_none(spark, monkeypatch):
    """With far more keys than bits single rows are taken for repeated ones, and the result is the same."""
    monkeypatch.setattr(repeats, "BITS", 64)
    rows = numbered(spark, 2000, 300)
    single, again = repeats.split_repeated(rows, "k")
    assert again.count() > 1500 and single.count() + again.count() == 2300
    first = cleaning.dedupe(rows, "k", [F.col("row")])
    assert first.count() == first.select("k").distinct().count() == 2000


def test_single_tickets_are_neither_ordered_nor_shuffled(spark):
    many = spark.range(3000).select(
        *[(F.concat(F.lit("TKT"), "id") if c == "ticket_id" else F.lit(v)).alias(c) for c, v in GOOD.items()]
    )
    rows = many.select(*STAGE_COLUMNS).unionByName(stage_rows(spark, {"ticket_id": "TKT7"}, {"ticket_id": " TKT8 "}))
    for made, n in ((cleaning.dedupe_tickets(rows), 3000), (cleaning.strict_clean(rows), 3001)):
        plan = plan_of(made, "simple")
        assert made.count() == n
        assert "Union" in plan and "BroadcastHashJoin" in plan and plan.index("Union") < plan.index("Exchange")
