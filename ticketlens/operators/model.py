"""The star: customers, agents, tickets, and the joined detail."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import MONTH, month_start
from ..functions.text import filled
from ..schema import (
    AGENT_COLUMNS,
    CUSTOMER_COLUMNS,
    THRESHOLD_HOURS,
    TICKET_COLUMNS,
    Rules,
    bucket_labels,
)
from ..sources.published import Published
from ..sources.shared import SharedTables, fingerprint, slice_of
from .cleaning import clean_copies, dedupe_tickets
from .quality import check_unique

#: Columns by whose values single tickets or groups of them are looked up, and those that rows are clustered by.
LOOKED_UP = ("agent_id", "channel", "category")
CLUSTERED = ("agent_id", "category")

#: The tables of a star that are stored, in the order in which they are made.
TABLES = ("stage", "copies", "clean", "customers", "agents")


def customers(clean: DataFrame) -> DataFrame:
    return clean.select(*CUSTOMER_COLUMNS).distinct()


def agents(clean: DataFrame) -> DataFrame:
    return clean.select(*AGENT_COLUMNS).distinct()


def tickets(clean: DataFrame) -> DataFrame:
    """The fact: the clean table without the two dimension attributes."""
    kept = [*TICKET_COLUMNS, MONTH] if MONTH in clean.columns else TICKET_COLUMNS
    return clean.select(*kept)


def with_month(df: DataFrame) -> DataFrame:
    """Add the month the stored tables are partitioned by."""
    return df.withColumn(MONTH, month_start(F.col("created_at")))


def resolution_bucket(threshold=THRESHOLD_HOURS):
    """Label of the bucket; a missing time belongs to none."""
    hours = F.col("resolution_hours")
    within, after = bucket_labels(threshold)
    return F.when(hours > threshold, after).when(hours <= threshold, within)


def _join_dimensions(tickets, customers, agents, need, how: str) -> DataFrame:
    # No broadcast hint: Spark compares each dimension's size with its threshold, and beyond it
    # sorts and merges, splitting a hot customer or agent over several tasks.
    joined = tickets
    if "customer_region" in need:
        joined = joined.join(customers, "customer_id", how)
    if "agent_name" in need:
        joined = joined.join(agents, "agent_id", how)
    return joined


def detail(
    tickets: DataFrame,
    customers: DataFrame | None,
    agents: DataFrame | None,
    need=("customer_region", "agent_name"),
    threshold=THRESHOLD_HOURS,
) -> DataFrame:
    """Tickets with the needed dimension attributes and the resolution bucket.

    Spark cannot drop an unused inner join, so only the dimensions in ``need`` are joined. Tickets
    without a match are left out; :func:`quality.orphans` counts them.
    """
    joined = _join_dimensions(tickets, customers, agents, need, "inner")
    bucket = resolution_bucket(threshold).alias("resolution_bucket")
    return joined.select(*tickets.columns, *need, bucket)


def widen(tickets: DataFrame, customers: DataFrame, agents: DataFrame) -> DataFrame:
    """Tickets with both attributes, kept even where a dimension has no match."""
    need = ("customer_region", "agent_name")
    joined = _join_dimensions(tickets, customers, agents, need, "left")
    return joined.select(*tickets.columns, *need)


def _refuse_repeated_key(key: str) -> Callable[[DataFrame], None]:
    def check(dimension: DataFrame) -> None:
        repeated = check_unique({key: (dimension, key)}).first()["bad_rows"]
        if repeated:
            raise ValueError(f"{repeated} values of {key} have more than one attribute value")

    return check


class Star:
    """The stage, first copies, clean table and model, each written at first use and then read back.

    The clean table is partitioned by month, and clustered in it by agent and category. The fact is its nine-column
    projection: Parquet reads only the columns asked for, so a second copy would gain nothing. Tables are named
    by what they were made from: ``source`` (else the stage's plan and files), the rules and the tie-break; stars of
    other rules share the stage of one source. A dimension key with two attribute values would multiply
    tickets in joins, so it stops the load, as a primary key would.

    Large tables are made in slices, each written before the next is shuffled: first copies by ticket, the clean table by
    month. A stage may come in slices too, as a list.
    """

    def __init__(
        self,
        tables: SharedTables,
        stage: Callable[[], DataFrame | Sequence[DataFrame]],
        rules: Rules = Rules(),
        tiebreak=(),
        source: str | None = None,
    ):
        self._tables = tables
        self._stage = stage
        self._rules = rules
        self._tiebreak = tuple(tiebreak)
        self._source = source

    @property
    def source(self) -> str:
        if self._source is None:
            staged = self._stage()
            parts = [staged] if isinstance(staged, DataFrame) else staged
            self._stage, self._source = (lambda: staged), "-".join(map(fingerprint, parts))
        return self._source

    def name(self, table: str) -> str:
        """The stored name of a table of this star."""
        made_from: tuple = (self.source,)
        if table != "stage":
            made_from += (self._tiebreak,)
        if table not in ("stage", "copies"):
            made_from += (self._rules,)
        return f"{table}-{hashlib.md5(repr(made_from).encode()).hexdigest()[:12]}"

    def table(self, name: str, build: Callable[[], DataFrame | Sequence[DataFrame]], **how) -> DataFrame:
        """A table of this star, kept apart from those of stars with other sources or rules."""
        return self._tables.table(self.name(name), build, **how)

    @property
    def stage(self) -> DataFrame:
        return self.table("stage", lambda: self._stage())

    @property
    def copies(self) -> DataFrame:
        """The first copy of every ticket, as staged: whole rows are deduplicated once."""

        def build() -> list[DataFrame]:
            stage, n = self.stage, self._tables.slices(self.name("stage"))
            slices = [slice_of(stage, filled("ticket_id"), k, n) for k in range(n)]
            return [dedupe_tickets(rows, self._tiebreak) for rows in slices]

        return self.table("copies", build)

    @property
    def clean(self) -> DataFrame:
        def build() -> list[DataFrame]:
            rows, n = with_month(clean_copies(self.copies, self._rules)), self._tables.slices(self.name("copies"))
            return [slice_of(rows, F.col(MONTH), k, n) for k in range(n)]

        return self.table("clean", build, partition=MONTH, cluster=CLUSTERED, lookup=LOOKED_UP)

    @property
    def customers(self) -> DataFrame:
        check = _refuse_repeated_key("customer_id")
        return self.table("customers", lambda: customers(self.clean), check=check)

    @property
    def agents(self) -> DataFrame:
        check = _refuse_repeated_key("agent_id")
        return self.table("agents", lambda: agents(self.clean), check=check)

    @property
    def tickets(self) -> DataFrame:
        return tickets(self.clean)

    def detail(self, *need: str, threshold=THRESHOLD_HOURS) -> DataFrame:
        """Tickets with the bucket and the needed dimension attributes.

        The clean table has the attributes beside the keys, and the load refuses a key with two of
        them, so this equals the join with the dimensions without joining.
        """
        for attribute, dimension in (("customer_region", "customers"), ("agent_name", "agents")):
            if attribute in need:
                getattr(self, dimension)
        bucket = resolution_bucket(threshold).alias("resolution_bucket")
        return self.clean.select(*TICKET_COLUMNS, MONTH, *need, bucket)

    def load(self) -> Star:
        """Write every table now instead of at first use."""
        for name in TABLES:
            getattr(self, name)
        return self


def register_views(spark: SparkSession, star: Star) -> None:
    """Make the model readable by name within one session, as the reporting layer does."""
    views = {
        "customers": star.customers,
        "agents": star.agents,
        "tickets": star.tickets.select(*TICKET_COLUMNS),
        "v_ticket_detail": star.detail("customer_region", "agent_name").drop(MONTH),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def publish(
    to: Published,
    stage: Callable[[], DataFrame],
    rules: Rules = Rules(),
    tiebreak=(),
    database: str | None = None,
    threshold=THRESHOLD_HOURS,
) -> Star:
    """Rebuild the whole model beside the published one, and switch to it once every table is written and checked.

    Until then, and for good if anything fails, readers see the version before. With ``database`` its catalogue
    tables and views (``customers``, ``agents``, ``tickets``, ``v_ticket_detail``) are moved to the new version,
    so that any session of the same catalogue finds the model by name.
    """
    with to.new_version() as tables:
        star = Star(tables, stage, rules, tiebreak).load()
        tables.label({name: star.name(name) for name in TABLES})
    if database is not None:
        register_tables(to, database, threshold)
    return star


def register_tables(published: Published, database: str, threshold=THRESHOLD_HOURS) -> None:
    """Catalogue tables over the published version, and permanent views by which they are read.

    The tables' names hold the version; each view is replaced in one step, and then the tables of versions that
    are gone are dropped from the catalogue.
    """
    spark, version = published.spark, published.current()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    named = {}
    for name in ("clean", "customers", "agents"):
        named[name] = f"`{database}`.`{name}_{version.id}`"
        if not spark.catalog.tableExists(named[name]):
            spark.catalog.createTable(named[name], path=version.path_of(name), source="parquet")
            if name == "clean":
                spark.catalog.recoverPartitions(named[name])
    within, after = bucket_labels(threshold)
    bucket = f"""CASE WHEN resolution_hours > {threshold} THEN '{after}'
        WHEN resolution_hours <= {threshold} THEN '{within}' END AS resolution_bucket"""
    columns = ", ".join(TICKET_COLUMNS)
    views = {
        "customers": f"SELECT {', '.join(CUSTOMER_COLUMNS)} FROM {named['customers']}",
        "agents": f"SELECT {', '.join(AGENT_COLUMNS)} FROM {named['agents']}",
        "tickets": f"SELECT {columns} FROM {named['clean']}",
        "v_ticket_detail": f"SELECT {columns}, customer_region, agent_name, {bucket} FROM {named['clean']}",
    }
    for name, query in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {query}")
    kept = {f"{name}_{one}" for one in published.versions() for name in named}
    for table in spark.catalog.listTables(database):
        if table.tableType == "EXTERNAL" and table.name not in kept and table.name.startswith(tuple(f"{n}_" for n in named)):
            spark.sql(f"DROP TABLE `{database}`.`{table.name}`")
