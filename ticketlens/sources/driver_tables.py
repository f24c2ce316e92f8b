"""A dirty ticket export derived from the order tables.

Each line item is one export row, and one in 53 is there twice. Every defect that cleaning looks for is
planted by key arithmetic, so any engine derives the same rows: blanks, padded and missing ids,
texts that are no date or number, values out of range, texts too long, an unknown channel, an agent
seen on bad rows only, line breaks, a second region and a second name for a key, hyphenated regions, and scores that
rounding twice gets wrong. Texts are built from whole numbers, never from doubles.
"""

from __future__ import annotations

from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import STAGE_COLUMNS, Rules
from .shared import slice_of, slices_of

TIEBREAK = ("l_partkey", "l_suppkey", "l_extendedprice")
CHANNELS = ("HIGH", "LOW", "MEDIUM", "NOT SPECIFIED", "URGENT")
RULES = Rules(
    domains=MappingProxyType({"channel": CHANNELS}),
    # Keys here are 64-bit numbers, which outgrow the default lengths on large data.
    max_lengths=MappingProxyType(
        {
            "ticket_id": 40,
            "customer_id": 24,
            "customer_region": 20,
            "agent_id": 24,
            "agent_name": 60,
            "channel": 20,
            "category": 30,
        }
    ),
)


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _whole(c: Column) -> Column:
    return c.cast("bigint").cast("string")


def _planted(column: Column, *defects: tuple[Column, object]) -> Column:
    """The column with a value put in its place where a condition holds; the first one counts."""
    chain = F
    for test, value in defects:
        chain = chain.when(test, value)
    return chain.otherwise(column)


def stage_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The export in slices of its orders, as many as the size of the line items and orders asks for."""
    n = slices_of(spark, *[f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders")])
    return [mapped_stage(spark, sf_dir, k, n) for k in range(n)]


def mapped_stage(spark: SparkSession, sf_dir: str, k: int = 0, slices: int = 1) -> DataFrame:
    """The eleven text columns of the export, and three keys that order copies of a ticket.

    The small dimensions are joined to each other first. Line items and orders both grow with the
    data, so neither is ever broadcast: they are sorted and merged, and hot keys are split at run
    time. The other sides are left to Spark's size threshold. Where that has line items shuffled by part and by
    supplier too, the short texts come first and the long name last, so that the least is moved.
    """

    def read(name: str) -> DataFrame:
        return read_driver_table(spark, sf_dir, name)

    places = (
        read("nation")
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name")
    )
    buyers = (
        read("customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "r_name")
    )
    requests = (
        slice_of(read("orders"), F.col("o_orderkey"), k, slices)
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "o_orderpriority", "r_name")
    )
    rows = (
        slice_of(read("lineitem"), F.col("l_orderkey"), k, slices)
        .join(read("part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .join(requests.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read("supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    )

    order_slot = F.col("l_orderkey") % 97
    line = F.col("l_linenumber")

    def order(size: int, slot: int) -> Column:
        return F.col("l_orderkey") % size == slot

    def part(size: int, slot: int) -> Column:
        return F.col("l_partkey") % size == slot

    price = F.floor(F.col("l_extendedprice") / 100)
    key = F.concat(F.lit("TKT"), F.col("l_orderkey"), F.lit("-"), line)
    unknown_channel, bad_date, bad_score = part(263, 9), part(211, 1), part(229, 4)
    columns = {
        "ticket_id": _planted(
            key,
            (order(401, 3), F.when(line % 2 == 0, " ").otherwise("")),
            (part(61, 7), F.concat(F.lit(" "), key, F.lit("  "))),
        ),
        "customer_id": _planted(
            F.concat(F.lit("CU"), F.col("o_custkey")),
            (part(281, 13), F.concat(F.lit(" CU"), F.col("o_custkey"))),
            (part(283, 14), ""),
        ),
        "customer_region": _planted(
            F.concat(F.lit("  "), F.replace(F.lower("r_name"), F.lit(" "), F.lit("-")), F.lit(" ")),
            (bad_date, "elsewhere"),
        ),
        "agent_id": _planted(
            F.concat(F.lit("AG"), F.col("l_suppkey")),
            (unknown_channel, "AG-OUTSIDE"),
            (order_slot == 0, ""),
            (order_slot == 1, "  "),
            (order_slot == 2, F.lit(None)),
        ),
        "agent_name": _planted(F.col("s_name"), (bad_score, "Somebody\nElse"), (unknown_channel, "Outside")),
        "channel": _planted(
            F.substr("o_orderpriority", F.lit(3)),
            (unknown_channel, "FAX"),
            (order(89, 3), F.lit(None)),
        ),
        "category": _planted(F.col("p_type"), (part(293, 15), " ")),
        "created_at": _planted(
            F.col("l_shipdate").cast("string"),
            (bad_date, "not a date"),
            (part(277, 12), "9999-12-31"),
        ),
        "first_response_minutes": _planted(
            F.concat(_whole(price), F.lit("."), line),
            (part(83, 0), ""),
            (part(227, 3), "n/a"),
            (part(239, 6), "0"),
        ),
        "resolution_hours": _planted(
            F.concat(_whole(F.col("l_quantity")), F.lit("."), line - 1),
            (part(79, 0), F.lit(None)),
            (part(223, 2), "12,5"),
            (part(233, 5), "-1.0"),
        ),
        "csat_score": _planted(
            F.concat(1 + F.col("l_partkey") % 5, F.lit(".0")),
            (part(73, 0), " "),
            (bad_score, "good"),
            (part(241, 7), "9.0"),
            (part(269, 10), "4.45"),
            (part(271, 11), "2.4999999999"),
        ),
    }
    # in seven of 509 orders one text is too long, another one each time
    for slot, name in enumerate(RULES.max_lengths):
        columns[name] = _planted(
            columns[name], (order(509, slot), F.concat(columns[name], F.lit("x" * 60)))
        )
    times = F.explode(F.sequence(F.lit(1), F.when((F.col("l_orderkey") * 7 + line) % 53 == 5, 2).otherwise(1)))
    staged = rows.select(*[columns[c].alias(c) for c in STAGE_COLUMNS], *TIEBREAK, times.alias("_time"))
    return staged.drop("_time")
