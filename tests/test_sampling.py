import hashlib
import math

import pytest
from plans import plan_of
from pyspark.sql import functions as F

from ticketlens.operators import columns, sampling


def ids(df):
    return {r["ticket_id"] for r in df.collect()}


def keyed(star):
    return star.tickets.select("ticket_id", "channel", "category")


def unit(key, seed=42):
    bits = int(hashlib.md5(f"{seed}{key}".encode()).hexdigest()[:13], 16)
    return (bits + 1) / 2**52


@pytest.mark.parametrize("n", [0, 1, 50, 2000])
def test_exact_sample_is_the_n_smallest(star, n):
    every = [r["ticket_id"] for r in keyed(star).collect()]
    expected = set(sorted(every, key=unit)[:n])
    got = sampling.exact_sample(keyed(star), "ticket_id", n, 42)
    assert got.count() == n and ids(got) == expected


def test_sample_larger_than_the_table_is_the_table(star):
    rows = keyed(star)
    for more in (0, 1, 5):
        got = sampling.exact_sample(rows, "ticket_id", rows.count() + more, 1)
        assert got.count() == rows.count()


@pytest.mark.parametrize("n", [0, 1, 90, 99, 100, 101, 1000, 1799, 1800, 1801, 2500])
def test_any_size_is_exact_and_rows_without_a_key_are_never_drawn(spark, n):
    rows = spark.range(2000).select(
        F.when(F.col("id") >= 200, F.concat(F.lit("T"), F.col("id"))).alias("ticket_id")
    )
    got = [r["ticket_id"] for r in sampling.exact_sample(rows, "ticket_id", n, 42).collect()]
    every = sorted((f"T{i}" for i in range(200, 2000)), key=unit)
    assert len(got) == len(set(got)) == min(n, 1800) and set(got) == set(every[:n])


def test_equal_draws_may_fill_more_than_a_slot(spark):
    """With one draw for all rows the key decides, however many they are."""
    rows = spark.range(3000).select(F.format_string("%05d", "id").alias("k"))
    got = sampling._smallest(rows, F.lit(0.5), "k", 1234)
    assert {r["k"] for r in got.collect()} == {f"{i:05d}" for i in range(1234)}


def test_the_whole_table_is_not_sorted(star):
    rows = keyed(star)
    plan = plan_of(sampling.exact_sample(rows, "ticket_id", rows.count(), 1), "simple")
    assert "Sort" not in plan and "TakeOrdered" not in plan


@pytest.mark.parametrize("n", [300, 3000])
def test_a_sample_reads_the_table_twice_at_most(star, n, monkeypatch):
    """Once to count, here, and once or twice in the plan of the result, which writes nothing."""
    monkeypatch.setattr(sampling, "SMALL", 1000)
    monkeypatch.setattr(sampling, "SLOTS", 64)  # so that the last slot is never empty
    plan = plan_of(sampling.exact_sample(keyed(star), "ticket_id", n, 1), "simple")
    assert plan.count("FileScan") == (1 if n <= 1000 else 2)
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan and "Window" not in plan


def test_only_the_last_slot_of_a_large_sample_is_ordered(star, monkeypatch):
    every = [r["ticket_id"] for r in keyed(star).collect()]
    for slots in (1, 50, 1 << 16):
        monkeypatch.setattr(sampling, "SMALL", 10)
        monkeypatch.setattr(sampling, "SLOTS", slots)
        for n in (11, 1500, len(every) - 1):
            assert ids(sampling.exact_sample(keyed(star), "ticket_id", n, 42)) == set(sorted(every, key=unit)[:n])


def test_sample_of_an_empty_table_is_empty(star):
    nothing = keyed(star).where("1 = 0")
    for n in (5, 50):
        assert sampling.exact_sample(nothing, "ticket_id", n, 1).isEmpty()


def test_sample_does_not_depend_on_partitioning(star):
    a = sampling.exact_sample(keyed(star).repartition(3), "ticket_id", 100, 9)
    b = sampling.exact_sample(keyed(star).coalesce(1), "ticket_id", 100, 9)
    assert ids(a) == ids(b) != ids(sampling.exact_sample(keyed(star), "ticket_id", 100, 10))


def test_weighted_sample(star):
    weights = {"channel": {"URGENT": 3.0, "LOW": 0.0}, "category": {"LARGE": 1e-6, "SMALL": 2.0}}
    weight = sampling.nested_weight(weights)

    def size(r):
        return weights["channel"].get(r["channel"], 1) * weights["category"].get(r["category"], 1)

    every = [r for r in keyed(star).collect() if size(r) > 0]
    draws = sorted(every, key=lambda r: -math.log(unit(r["ticket_id"])) / size(r))
    for n in (100, 3000):
        expected = {r["ticket_id"] for r in draws[:n]}
        got = sampling.weighted_sample(keyed(star), "ticket_id", weight, n, 42)
        assert ids(got) == expected
    assert got.where("channel = 'LOW'").isEmpty()


def test_weights_shift_the_chances(star):
    rows = keyed(star)
    heavy = sampling.weighted_sample(
        rows, "ticket_id", sampling.nested_weight({"channel": {"URGENT": 5.0}}), 1000, 3
    )
    plain = sampling.exact_sample(rows, "ticket_id", 1000, 3)
    urgent = F.count_if(F.col("channel") == "URGENT")
    assert heavy.agg(urgent).first()[0] > 1.5 * plain.agg(urgent).first()[0]


def test_shuffled_keeps_all_rows_in_hash_order(star):
    placed = sampling.shuffled(keyed(star), "ticket_id", 4).collect()
    assert sorted(r["position"] for r in placed) == list(range(1, len(placed) + 1))
    got = [r["ticket_id"] for r in sorted(placed, key=lambda r: r["position"])]
    assert got == sorted(got, key=lambda k: hashlib.md5(f"4{k}".encode()).hexdigest())
    assert len(got) == star.tickets.count()


def test_rows_without_a_key_have_a_place_in_any_partitioning(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 != 0, F.col("id") % 1500).alias("k"), (F.col("id") % 700).alias("x"), F.lit(None).alias("y")
    )
    one = sampling.shuffled(rows.repartition(3), "k", 5).collect()
    other = sampling.shuffled(rows.repartition(17, "x"), "k", 5).collect()
    assert sorted(r["position"] for r in one) == list(range(1, 6001))
    assert {r["position"]: (r["k"], r["x"]) for r in one} == {r["position"]: (r["k"], r["x"]) for r in other}
    assert {r["position"] for r in one if r["k"] is None} == set(range(4001, 6001))


def test_equal_rows_are_spread_over_slices(spark):
    rows = spark.range(8000).select(F.lit(None).cast("string").alias("k"))
    from ticketlens.operators import ranking

    sizes = []
    real = ranking._in_slices

    def watched(df, order):
        placed = real(df, order)
        sizes.extend(r["count"] for r in placed.groupBy("_slice").count().collect())
        return placed

    ranking._in_slices = watched
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sampling.shuffled(rows, "k", 1).agg(F.max("position")).first()[0] == 8000
    finally:
        ranking._in_slices = real
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 3000


def test_key_is_padded_and_never_cut(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "n long")
    got = columns.key_format(df, "n", "CU", 5, "k")
    assert [r["k"] for r in got.collect()] == ["CU00007", "CU1234567"]


def test_clip_and_union(spark):
    df = spark.createDataFrame([(0.1,), (5.0,), (99.0,), (None,)], "x double")
    clipped = columns.clip_values(df, {"x": (0.3, 23.9)})
    assert [r["x"] for r in clipped.collect()] == [0.3, 5.0, 23.9, None]
    assert columns.union_all(df, df).count() == 8


def test_places_are_given_where_the_slices_are_sorted(spark, monkeypatch):
    """Rows are shuffled once, and no window brings several slices into one task."""
    from ticketlens.operators import ranking

    monkeypatch.setattr(ranking, "SLICE_ROWS", 100)
    rows = spark.range(3000).select(F.concat(F.lit("K"), "id").alias("k"))
    placed = sampling.shuffled(rows, "k", 5)
    assert "row_number" not in plan_of(placed)
    got = [r["k"] for r in sorted(placed.collect(), key=lambda r: r["position"])]
    assert got == [r["k"] for r in rows.orderBy(sampling.hash_text("k", 5)).collect()]
    assert [r["position"] for r in placed.orderBy("position").collect()] == list(range(1, 3001))
    assert len({f.rpartition("/part-")[2][:5] for f in slices_of(placed)}) == 30


def slices_of(placed):
    return [f for f in placed.inputFiles() if "/slices-" in f]
