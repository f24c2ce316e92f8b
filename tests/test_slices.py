"""Large tables are made in slices, and what is shuffled for one is removed before the next."""

import time

import __spark_entry__ as entry
import pytest
from conftest import SMALL
from rows import stage_rows

from ticketlens.operators import cleaning, model
from ticketlens.schema import STAGE_COLUMNS
from ticketlens.sources import driver_tables as driver
from ticketlens.sources import shared


def same_rows(one, other) -> bool:
    return one.count() == other.count() and one.exceptAll(other.select(*one.columns)).isEmpty()


def shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = blocks.getAllFiles().mkString("\n").split("\n")
    return {name.rpartition("/")[2] for name in names if "/shuffle_" in name}


def left_behind(spark, before: set[str]) -> set[str]:
    """Shuffle files that were not there before; they are removed in the background."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


@pytest.fixture
def small_slices(star, monkeypatch):
    """Stars of the smallest tables are made in slices from now on; the one of the session is there."""
    star.load()
    monkeypatch.setattr(shared, "SLICE_BYTES", 50_000)


def test_what_a_written_table_shuffled_is_removed(spark):
    path, before = shared.scratch_path(spark, "shuffled"), shuffle_files(spark)
    shared.write_table(spark.range(100_000).repartition(8, "id"), path)
    assert not left_behind(spark, before)
    assert spark.read.parquet(path).count() == 100_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_row_is_in_one_slice(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), *[(f"K{i % 50}", i) for i in range(200)]], "k string, v int")
    slices = [shared.slice_of(rows, rows["k"], k, 4) for k in range(4)]
    assert sorted(r["v"] for s in slices for r in s.collect()) == sorted(r["v"] for r in rows.collect())
    held = [{r["k"] for r in s.select("k").distinct().collect()} for s in slices]
    assert sum(map(len, held)) == len(set.union(*held)) == 51 and all(held)


def test_a_star_made_in_slices_is_the_same_and_leaves_no_shuffle_files(spark, star, small_slices, monkeypatch):
    names = ("calendar", "orphan_tickets", "agent_ranking")
    whole = [entry.queries()[name](spark, SMALL) for name in names]
    monkeypatch.setattr(shared, "_SHARED", {})
    parts = driver.stage_slices(spark, SMALL)
    assert len(parts) > 1 and not any(part.isEmpty() for part in parts)

    before = shuffle_files(spark)
    made = [entry.queries()[name](spark, SMALL) for name in names]
    assert not left_behind(spark, before)
    sliced = entry.star(spark, SMALL)
    assert sliced._tables is not star._tables
    assert sliced._tables.slices(sliced.name("stage")) > 1 and sliced._tables.slices(sliced.name("copies")) > 1
    for table in model.TABLES:
        assert same_rows(getattr(star, table), getattr(sliced, table)), table
    for name, one, other in zip(names, whole, made, strict=True):
        assert same_rows(one, other), name


def test_copies_in_other_slices_of_the_stage_are_found(spark, small_slices):
    """Slices of the stage say nothing about tickets, and rows without a key are in none."""
    one = stage_rows(spark, {"ticket_id": "A"}, {"ticket_id": None}, {"ticket_id": " B ", "created_at": None})
    other = stage_rows(spark, {"ticket_id": "A ", "created_at": "2024-01-01"}, {"ticket_id": "B"}, {"ticket_id": " "})
    made = model.Star(shared.SharedTables(spark, "two"), lambda: [one, other])
    assert made.stage.count() == 6
    assert same_rows(cleaning.dedupe_tickets(one.unionByName(other)), made.copies)
    assert {r["ticket_id"]: r["created_at"] for r in made.copies.select(*STAGE_COLUMNS).collect()} == {
        "A": "2024-01-01",
        "B": "2025-01-05 10:00:00",
    }
