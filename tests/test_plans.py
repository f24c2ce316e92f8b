"""What the plans must look like to hold on large data."""

import re
from collections import Counter, defaultdict
from datetime import date

import __spark_entry__ as entry
import pytest
from conftest import SMALL
from plans import executed_plan, plan_of
from pyspark.sql import functions as F
from rows import GOOD

from ticketlens.operators import cleaning, measures, model, quality
from ticketlens.plans import analysis, reports
from ticketlens.schema import STAGE_COLUMNS
from ticketlens.sources.shared import read_table, scratch_path, write_table


def read_schemas(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


@pytest.mark.parametrize("name", [n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)])
def test_no_query_pairs_all_rows(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan, "every expression is a built-in one"


def test_questions_read_their_columns_once(star):
    wanted = {
        analysis.channel_share: "first_response_minutes:decimal(7,1),channel:string,csat_score",
        analysis.csat_by_bucket: "resolution_hours:decimal(6,1),csat_score",
        analysis.monthly_volume: "csat_score:smallint",
        analysis.channel_bucket_matrix: "channel:string,resolution_hours:decimal(6,1),csat_score",
    }
    for question, columns in wanted.items():
        schemas = read_schemas(plan_of(question(star.tickets)))
        assert len(schemas) == 1, question.__name__
        found = {c.split(":")[0] for c in schemas[0].split(",") if ":" in c}
        assert found == {c.split(":")[0] for c in columns.split(",") if ":" in c} | (
            {"csat_score"} if "csat_score" in columns else set()
        ), question.__name__


@pytest.mark.parametrize(
    ("report", "scans"),
    [
        (reports.pivot_channel, 1),
        (reports.pivot_resolution, 1),
        # a second narrow scan for the totals, instead of a window over groups of free text
        (reports.pivot_category, 2),
        (reports.insights, 2),
    ],
)
def test_summaries_scan_the_tickets(star, report, scans):
    assert plan_of(report(star.tickets), "simple").count("FileScan") == scans


def test_many_categories_meet_in_no_single_task(spark, star):
    """No window over all groups: only one-row totals and top rows have a single partition."""
    many = star.tickets.withColumn("category", F.concat("category", F.lit("-"), F.col("ticket_id")))
    regions = star.customers.withColumn("customer_region", F.col("customer_id"))
    for df in (
        reports.pivot_category(many),
        reports.insights(many),
        analysis.regional_csat(many, regions),
    ):
        assert "Window" not in executed_plan(df)
    breach = executed_plan(analysis.sla_breach(many))
    for line in breach.splitlines():
        if "Window [" in line:
            assert "_slice" in line


def test_region_question_folds_before_it_joins(star):
    plan = plan_of(analysis.regional_csat(star.tickets, star.customers), "simple")
    join = plan.index("Join")
    assert "HashAggregate(keys=[customer_id" in plan[join:]


def test_threshold_filter_reaches_the_scan(star):
    plan = plan_of(star.tickets.where("resolution_hours > 24").agg(F.count("*")))
    assert "GreaterThan(resolution_hours,24.0)" in plan


def test_scorecard_filter_reaches_the_scan(star):
    plan = plan_of(reports.agent_scorecard(star.tickets, star.agents, "AG3"))
    assert plan.count("EqualTo(agent_id,AG3)") == 2


def test_month_slicer_prunes_partitions(star):
    plan = plan_of(measures.evaluate(star.tickets, slicers={"month": [date(1997, 1, 1)]}))
    assert re.search(r"PartitionFilters: \[.*created_month", plan)


def test_copies_are_dropped_before_the_shuffle(star):
    plan = plan_of(cleaning.dedupe_tickets(star.stage), "simple")
    final, shuffle, partial = (
        plan.index("row_number(), 1, Final"),
        plan.index("Exchange hashpartitioning(ticket_id"),
        plan.index("row_number(), 1, Partial"),
    )
    assert final < shuffle < partial


def test_detail_of_a_star_joins_nothing(star):
    assert "Join" not in plan_of(star.detail("agent_name", "customer_region"), "simple")
    joined = model.detail(star.tickets, star.customers, star.agents, ("agent_name",))
    assert plan_of(joined, "simple").count("Join") == 1


def test_whole_rows_are_deduplicated_once(star):
    readers = [
        cleaning.clean_copies(star.copies),
        cleaning.quarantine(star.stage, copies=star.copies),
        cleaning.incomplete(star.stage, per="ticket", copies=star.copies),
        cleaning.losses(star.stage, star.copies),
    ]
    for df in readers:
        assert "row_number" not in plan_of(df, "simple")


def test_orphans_never_group_by_pairs(star):
    plan = plan_of(quality.orphans(star.tickets, star.customers, star.agents), "simple")
    assert not re.search(r"hashpartitioning\(customer_id#\d+, agent_id", plan)


@pytest.fixture
def small_limits(spark):
    """Make run-time splitting visible on small data."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


HOT = 6000


@pytest.fixture(scope="module")
def skewed_stage(spark):
    """One ticket, one customer and one agent hold far more than a third of the rows."""
    i = F.col("id")
    hot = i < HOT
    text = {**{c: F.lit(v) for c, v in GOOD.items()}}
    text["ticket_id"] = F.when(i < HOT // 2, "TKT0").otherwise(F.concat(F.lit("TKT"), i))
    text["customer_id"] = F.when(hot, "CU0").otherwise(F.concat(F.lit("CU"), i % 200))
    text["customer_region"] = F.when(F.substring(text["customer_id"], -1, 1) < "5", "north").otherwise(
        "south"
    )
    text["agent_id"] = F.when(hot, "AG0").otherwise(F.concat(F.lit("AG"), i % 50))
    text["agent_name"] = F.concat(F.lit("Agent "), text["agent_id"])
    text["csat_score"] = (1 + i % 5).cast("string")
    text["created_at"] = F.concat(F.lit("2025-01-"), F.lpad((1 + i % 28).cast("string"), 2, "0"))
    rows = spark.range(0, 10000, 1, 12).select(*[text[c].alias(c) for c in STAGE_COLUMNS])
    path = scratch_path(spark, "skewed")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_hot_keys_are_split_in_joins(spark, skewed_stage, small_limits):
    path = scratch_path(spark, "hot")
    cleaning.clean_tickets(skewed_stage).repartition(12).write.parquet(path)
    clean = spark.read.parquet(path)
    customers, agents = model.customers(clean), model.agents(clean)
    joined = model.detail(model.tickets(clean), customers, agents, ("customer_region",))
    assert "SortMergeJoin(skew=true)" in executed_plan(joined)
    assert joined.count() == clean.count()


def test_a_hot_month_is_written_to_several_files(spark, small_limits):
    rows = spark.range(0, 200_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("v"), F.lit(date(2025, 1, 1)).alias("created_month")
    )
    path = scratch_path(spark, "months")
    write_table(rows, path, "created_month")
    assert len(read_table(spark, path, rows).inputFiles()) > 4


def test_results_hold_on_hot_keys(spark, skewed_stage):
    rows = [r.asDict() for r in skewed_stage.collect()]
    first = {}
    for r in sorted(rows, key=lambda r: (r["created_at"], *[r[c] for c in STAGE_COLUMNS])):
        first.setdefault(r["ticket_id"], r)
    assert len(first) == 10000 - HOT // 2 + 1

    clean = cleaning.clean_tickets(skewed_stage)
    assert {r["ticket_id"]: str(r["csat_score"]) for r in clean.collect()} == {
        k: r["csat_score"] for k, r in first.items()
    }
    profile = quality.profile(skewed_stage).first()
    assert profile["duplicate_rows"] == HOT // 2 - 1
    exact = len(rows) - len(Counter(tuple(r.values()) for r in rows))
    assert profile["exact_duplicates"] == exact

    tickets, customers, agents = model.tickets(clean), model.customers(clean), model.agents(clean)
    sums = defaultdict(list)
    for r in first.values():
        sums[r["customer_region"].title()].append(int(r["csat_score"]))
    got = {r["customer_region"]: r["tickets"] for r in analysis.regional_csat(tickets, customers).collect()}
    assert got == {k: len(v) for k, v in sums.items()}
    assert quality.orphans(tickets, customers.where("customer_id <> 'CU0'"), agents).first()[0] == sum(
        r["customer_id"] == "CU0" for r in first.values()
    )


def test_tickets_are_not_shuffled_to_mark_few_orphans(spark, star):
    """Tickets are larger than the threshold, their unknown keys are not."""
    rows, customers, agents = star.tickets, star.customers, star.agents
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, "8KB")
    try:
        found = quality.orphans(rows, customers.where("customer_id <> 'CU7'"), agents)
        assert "SortMergeJoin" not in plan_of(found, "simple")
        assert found.first()[0] == rows.where("customer_id = 'CU7'").count() > 0
    finally:
        spark.conf.set(name, before)
