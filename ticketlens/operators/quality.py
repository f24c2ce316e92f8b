"""Counts of what breaks the model's rules. Constraints become checks that return numbers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled, is_blank
from ..schema import STAGE_COLUMNS, Rules
from ..sources.shared import pinned
from .cleaning import CAST_COLUMNS, TEXT_COLUMNS, inside, typed, typed_columns


def _as_rows(counts: DataFrame, check: str, names: list[str]) -> DataFrame:
    """One row per counted column instead of one column per count."""
    pairs = [
        F.struct(F.lit(check).alias("check"), F.lit(n).alias("column"), F.col(f"`{n}`").alias("bad_rows"))
        for n in names
    ]
    return counts.select(F.inline(F.array(*pairs)))


def _count_all(df: DataFrame, check: str, tests: Mapping[str, Column]) -> DataFrame:
    """All tests in one pass over the data."""
    counts = df.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])
    return _as_rows(counts, check, list(tests))


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def profile(stage: DataFrame, id_col: str = "ticket_id") -> DataFrame:
    """Rows, distinct ids, rows beyond the first of each id, and exact copies, as one row.

    Equal rows are folded first, then ids, so a hot id is folded in every task. Rows without an id
    count as duplicates.
    """
    distinct_rows = stage.groupBy(*STAGE_COLUMNS).agg(F.count("*").alias("copies"))
    ids = distinct_rows.groupBy(id_col).agg(
        F.sum("copies").alias("rows"), F.count("*").alias("distinct_rows")
    )
    total, ids_seen = F.sum("rows"), F.count(id_col)
    return ids.agg(
        F.coalesce(total, F.lit(0)).alias("raw_rows"),
        ids_seen.alias("distinct_ids"),
        F.coalesce(total - ids_seen, F.lit(0)).alias("duplicate_rows"),
        F.coalesce(total - F.sum("distinct_rows"), F.lit(0)).alias("exact_duplicates"),
    )


def check_unique(keys: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """For every named key, how many of its values occur more than once."""
    parts = []
    for name, (df, key) in keys.items():
        repeated = df.groupBy(key).count().where("count > 1")
        parts.append(repeated.agg(F.count("*").alias(name)).transform(_as_rows, "unique", [name]))
    return _stack(parts)


def check_not_null(df: DataFrame, columns=STAGE_COLUMNS) -> DataFrame:
    text = dict(df.dtypes)
    tests = {c: is_blank(c) if text[c] == "string" else F.col(c).isNull() for c in columns}
    return _count_all(df, "not null", tests)


def check_domain(stage: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Filled values outside the fixed domain of their column."""
    tests = {c: ~filled(c).isin(*allowed) for c, allowed in rules.domains.items()}
    return _count_all(stage, "domain", tests)


def check_range(stage: DataFrame, ranges: Mapping | None = None) -> DataFrame:
    """Numbers outside their range; several ranges per column may be asked for."""
    asked = Rules().ranges if ranges is None else ranges
    tests = {}
    for column, allowed in asked.items():
        for one in allowed if isinstance(allowed, (list, tuple)) else [allowed]:
            tests[f"{column} {one}"] = ~inside(F.col(column), one)
    return _count_all(typed(stage), "range", tests)


def check_castable(stage: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Texts that are present but cannot be cast, and texts that are too long."""
    cells = typed_columns()
    tests = {c: ~is_blank(c) & cells[c].isNull() for c in CAST_COLUMNS}
    for c in TEXT_COLUMNS:
        if c in rules.max_lengths:
            tests[c] = F.length(cells[c]) > rules.max_lengths[c]
    return _count_all(stage, "castable", tests)


def check_dim_conflicts(df: DataFrame, pairs) -> DataFrame:
    """For every (key, attribute) pair, how many filled keys carry more than one value.

    All pairs share one pass and one exchange: a key's least and greatest value differ where it has more than one,
    and both are kept up while tasks fold their rows, so a hot key is one row of each task.
    """
    named = {f"{key} -> {attribute}": (key, attribute) for key, attribute in pairs}
    cells = [
        F.struct(F.lit(name).alias("pair"), filled(key).alias("k"), filled(attribute).alias("v"))
        for name, (key, attribute) in named.items()
    ]
    seen = df.select(F.inline(F.array(*cells))).dropna("any")
    split = seen.groupBy("pair", "k").agg(F.min("v").alias("least"), F.max("v").alias("most")).where("least <> most")
    return _count_all(split, "dim conflict", {name: F.col("pair") == name for name in named})


def orphans(tickets: DataFrame, customers: DataFrame, agents: DataFrame) -> DataFrame:
    """Tickets whose customer or agent is missing from its dimension, each counted once.

    The distinct keys of the tickets, folded in every task, are held against the dimensions. Those that
    are unknown, normally none, are written, so that Spark knows how few they are when it plans how they mark
    their tickets: only beyond its broadcast threshold are tickets shuffled. Keys are trimmed, as cleaning does it;
    a ticket without a key is an orphan.
    """
    rows = tickets.select(filled("customer_id").alias("customer_id"), filled("agent_id").alias("agent_id"))
    marked = rows
    for key, dimension in (("customer_id", customers), ("agent_id", agents)):
        unknown = pinned(rows.select(key).distinct().join(dimension, key, "left_anti"), "unknown")
        marked = marked.join(unknown.select(key, F.lit(True).alias(f"no_{key}")), key, "left")
    lost = marked.where(
        "no_customer_id OR no_agent_id OR customer_id IS NULL OR agent_id IS NULL"
    )
    return lost.agg(F.count("*").alias("orphan_tickets"))


def reconcile(
    stage: DataFrame, tickets: DataFrame, customers: DataFrame, agents: DataFrame
) -> DataFrame:
    """Rows in, rows kept, rows removed and dimension sizes, as one row."""

    def rows(df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n"))

    raw = rows(stage).select(
        F.col("n").alias("raw_rows"),
        rows(tickets).scalar().alias("clean_rows"),
        rows(customers).scalar().alias("customers"),
        rows(agents).scalar().alias("agents"),
    )
    removed = (F.col("raw_rows") - F.col("clean_rows")).alias("total_removed")
    return raw.select("raw_rows", "clean_rows", removed, "customers", "agents")
