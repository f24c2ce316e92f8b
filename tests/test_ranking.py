import random

import pytest
from plans import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from ticketlens.operators import ranking
from ticketlens.plans import analysis


@pytest.fixture(autouse=True, scope="module")
def eight_slices(spark):
    """Keep small slices apart, which adaptive execution would join."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def entities(spark, scores):
    rows = [(f"E{i:05d}", s) for i, s in enumerate(scores)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "id string, score double")


def by_windows(df, tiles):
    one, both = Window.orderBy(F.desc("score")), Window.orderBy(F.desc("score"), "id")
    return df.select(
        "id",
        F.rank().over(one).alias("rank"),
        F.dense_rank().over(one).alias("dense_rank"),
        F.ntile(tiles).over(both).alias("tile"),
    )


def ranks(df):
    return {r["id"]: (r["rank"], r["dense_rank"], r["tile"]) for r in df.collect()}


def _cases():
    rng = random.Random(7)
    yield "distinct", [float(i) for i in range(200)]
    yield "few values", [float(rng.randint(1, 5)) for _ in range(500)]
    yield "all equal", [3.0] * 150
    yield "a third equal", [3.0] * 100 + [rng.random() * 5 for _ in range(200)]
    yield "one", [1.0]
    yield "fewer than tiles", [2.0, 1.0]
    yield "none", []


@pytest.mark.parametrize(("name", "scores"), list(_cases()), ids=lambda v: v if isinstance(v, str) else "")
def test_slices_equal_plain_windows(spark, name, scores):
    df = entities(spark, scores)
    expected = ranks(by_windows(df, 4))
    assert ranks(ranking.rank_entities(df, "score", ("id",))) == expected


def test_joined_slices_give_the_same(spark):
    df = entities(spark, [float(i % 90) for i in range(3000)])
    apart = ranks(ranking.rank_entities(df, "score", ("id",)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    try:
        assert ranks(ranking.rank_entities(df, "score", ("id",))) == apart
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")


def test_equal_scores_are_spread_over_slices(spark):
    """A score held by every row must not end up in one task."""
    df = entities(spark, [3.0] * 4000)
    order = [F.col("score").desc(), F.col("id").asc()]
    rows, _ = ranking._ranks_in_slices(df, "score", order, 4)
    sizes = [r["count"] for r in rows.groupBy("_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500


@pytest.mark.parametrize("tiles", [1, 2, 4, 7])
def test_tile_formula(spark, tiles):
    pairs = spark.range(1, 40).selectExpr("id AS n").selectExpr("n", "explode(sequence(1L, n)) AS i")
    got = pairs.select(
        "n",
        "i",
        ranking.tile_of(F.col("i"), F.col("n"), tiles).alias("tile"),
        F.ntile(tiles).over(Window.partitionBy("n").orderBy("i")).alias("expected"),
    )
    assert got.where("tile <> expected OR tile IS NULL").isEmpty()


@pytest.mark.parametrize(("name", "scores"), list(_cases()), ids=lambda v: v if isinstance(v, str) else "")
@pytest.mark.parametrize("n", [1, 7, 120])
def test_the_first_rows_are_ranked_as_among_all(spark, name, scores, n):
    df = entities(spark, scores)
    every = ranks(by_windows(df, 4))
    first = sorted(every, key=lambda k: (-dict(zip((f"E{i:05d}" for i in range(len(scores))), scores, strict=True))[k], k))[:n]
    assert ranks(ranking.top_ranked(df, "score", ("id",), n)) == {k: every[k] for k in first}


def test_top_rows_need_no_range_exchange_and_no_written_table(star):
    plan = plan_of(analysis.agent_leaderboard(star.tickets, star.agents))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan and "slices" not in plan
    quartiles = analysis.agent_quartiles(star.tickets, star.agents)
    assert "rangepartitioning" not in plan_of(quartiles.select("agents")) and "Window" not in plan_of(quartiles)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 10, 11])
@pytest.mark.parametrize("tiles", [1, 4, 7])
def test_tile_sizes_by_count(spark, n, tiles):
    got = {r["tile"]: r["rows"] for r in ranking.tile_sizes(spark.range(n), tiles).collect()}
    dealt = spark.range(n).select(F.ntile(tiles).over(Window.orderBy("id")).alias("tile"))
    assert got == {r["tile"]: r["count"] for r in dealt.groupBy("tile").count().collect()}


def test_no_two_slices_meet_in_one_task(spark):
    df = entities(spark, [float(i) for i in range(4000)])
    order = [F.col("score").desc(), F.col("id").asc()]
    rows, _ = ranking._ranks_in_slices(df, "score", order, 4)
    ranked = rows.where("_rank > 0 AND _dense > 0")
    tasks = ranked.select("_slice", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(tasks) == len({r["task"] for r in tasks}) == 8
