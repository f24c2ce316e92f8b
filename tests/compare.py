"""Run every registered query and its SQL side by side: ``python tests/compare.py [sf_dir] [key ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "conversations")


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if v is None:
        return "NULL"
    return f"{type(v).__name__}:{v}"


def bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a description of the difference."""
    rows = df.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {df.columns} against {names}"
    ours, theirs = bag(df.columns, rows), bag(names, result.fetchall())
    if ours == theirs:
        return None
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())};"
        f" only here {list(only_ours.items())[:2]}; only there {list(only_theirs.items())[:2]}"
    )


def main() -> int:
    import __spark_entry__ as entry

    from ticketlens.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session("compare"), duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(query(spark, sf_dir), con, oracle[name]) if name in oracle else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}")
    print(f"{len(queries)} queries, {len(oracle)} with SQL, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
