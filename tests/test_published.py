"""Versions that are switched as a whole, tables named by their source, and reads that skip row groups."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import stage_rows

from ticketlens.operators import model
from ticketlens.schema import STAGE_COLUMNS, Rules
from ticketlens.sources import shared
from ticketlens.sources.published import Published


@pytest.fixture
def three(spark):
    return stage_rows(spark, *[{"ticket_id": f"T{k}", "created_at": f"2025-0{k + 1}-05 10:00:00"} for k in range(3)])


def test_a_rebuild_replaces_all_tables_at_once(spark, tmp_path, three):
    to = Published(spark, str(tmp_path / "model"), keep=1)
    with pytest.raises(LookupError):
        to.current()
    model.publish(to, lambda: three)
    assert (to.read("clean").count(), to.read("stage").count(), len(to.versions())) == (3, 3, 1)
    first = to.current()
    model.publish(to, lambda: three.where("ticket_id <> 'T0'"))
    assert to.read("clean").count() == to.read("stage").count() == 2
    assert to.versions() != [first.id] and not Path(first.path).exists()
    again = Published(spark, str(tmp_path / "model"))
    assert again.read("customers").collect() == to.read("customers").collect()
    assert [str(r[0]) for r in again.read("clean").select("created_month").orderBy("created_month").collect()] == [
        "2025-02-01",
        "2025-03-01",
    ]


def test_a_failed_rebuild_leaves_the_last_version_readable(spark, tmp_path, three):
    to = Published(spark, str(tmp_path / "model"))
    model.publish(to, lambda: three)
    before = to.versions()
    two_regions = stage_rows(spark, {"ticket_id": "A"}, {"ticket_id": "B", "customer_region": "south"})
    with pytest.raises(ValueError, match="more than one"):
        model.publish(to, lambda: two_regions)
    broken = three.withColumn("agent_id", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        model.publish(to, lambda: broken)
    assert to.versions() == before and to.read("clean").count() == 3
    assert sorted(p.name for p in (tmp_path / "model").glob("v*")) == before


def test_readers_of_the_version_before_can_finish(spark, tmp_path, three):
    to = Published(spark, str(tmp_path / "model"), keep=2)
    model.publish(to, lambda: three)
    reading = to.read("clean")
    model.publish(to, lambda: three.where("ticket_id = 'T1'"))
    assert reading.count() == 3 and to.read("clean").count() == 1 and len(to.versions()) == 2


def test_another_session_finds_the_model_by_name(spark, tmp_path, three):
    to = Published(spark, str(tmp_path / "model"), keep=1)
    model.publish(to, lambda: three, database="desk")
    other = spark.newSession()
    try:
        count = "SELECT count(*) FROM desk.{}"
        assert [other.sql(count.format(t)).first()[0] for t in ("tickets", "customers", "agents")] == [3, 1, 1]
        detail = other.table("desk.v_ticket_detail")
        assert detail.columns[-3:] == ["customer_region", "agent_name", "resolution_bucket"]
        assert other.table("desk.tickets").columns == list(model.TICKET_COLUMNS)
        model.publish(to, lambda: three.where("ticket_id <> 'T0'"), database="desk")
        assert other.sql(count.format("tickets")).first()[0] == 2
        assert detail.columns == other.table("desk.v_ticket_detail").columns
        stored = [t.name for t in other.catalog.listTables("desk") if t.tableType == "EXTERNAL"]
        assert len(stored) == 3 and all(to.versions()[0] in name for name in stored)
    finally:
        spark.sql("DROP DATABASE IF EXISTS desk CASCADE")


def test_two_sources_on_the_same_tables_never_meet(spark, star):
    tables = shared.SharedTables(spark, "sources")
    small = stage_rows(spark, *[{"ticket_id": f"T{k}"} for k in range(10)])
    smaller = stage_rows(spark, *[{"ticket_id": f"T{k}"} for k in range(7)])
    counts = [model.Star(tables, lambda df=df: df).clean.count() for df in (small, smaller, small)]
    assert counts == [10, 7, 10]
    one = model.Star(tables, lambda: small)
    assert one.name("stage") == model.Star(tables, lambda: small, replace(Rules(), domains={})).name("stage")
    assert one.name("clean") != model.Star(tables, lambda: small, replace(Rules(), domains={})).name("clean")


def test_changed_files_are_another_source(spark, tmp_path):
    rows = stage_rows(spark, {"ticket_id": "A"}, {"ticket_id": "B"})
    path = str(tmp_path / "nested" / "month=1")
    rows.write.parquet(path)

    def stage():
        return spark.read.parquet(str(tmp_path / "nested")).select(*STAGE_COLUMNS)

    before, tag = shared.fingerprint(stage()), shared.source_tag(spark, str(tmp_path))
    assert shared.fingerprint(stage()) == before
    rows.write.mode("append").parquet(path)
    assert shared.fingerprint(stage()) != before
    assert shared.source_tag(spark, str(tmp_path)) != tag
    tables = shared.SharedTables(spark, "changed")
    assert model.Star(tables, stage).stage.count() == 4


def scanned(df):
    """Rows that the scan of a plan without exchanges handed on, after row groups were left out."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return len(rows), leaves.apply(0).metrics().apply("numOutputRows").value()


def test_one_agent_or_category_reads_few_row_groups(spark, tmp_path):
    n = 200_000
    rows = spark.range(n).select(
        F.format_string("TKT%07d", "id").alias("ticket_id"),
        F.format_string("AG%04d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2000))).alias("agent_id"),
        F.format_string("cat%03d", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(150))).alias("category"),
        F.element_at(F.array(*map(F.lit, "abcde")), (F.pmod("id", F.lit(5)) + 1).cast("int")).alias("channel"),
        F.lit("2025-01-01").cast("date").alias("created_month"),
    )
    how = {"partition": "created_month", "row_group_bytes": 16 << 10}
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    shared.write_table(rows.repartition(8), plain, **how)
    shared.write_table(rows.repartition(8), clustered, cluster=model.CLUSTERED, lookup=model.LOOKED_UP, **how)
    for where in ("agent_id = 'AG0077'", "category = 'cat042'"):
        found, all_read = scanned(spark.read.parquet(plain).where(where).select("ticket_id"))
        same, few_read = scanned(spark.read.parquet(clustered).where(where).select("ticket_id"))
        assert found == same > 50
        assert all_read > n / 2 and few_read < n / 5
