"""Run queries against their SQL twins: python tests/oracle_check.py [sf] [names...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem".split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _key(value):
    return (value is not None, str(type(value)) if value is not None else "", value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    kept = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(kept, key=lambda row: [_key(v) for v in row])


def difference(spark_rows, sql_rows) -> str | None:
    """What differs, or None. Values must be equal to the last digit."""
    (our_columns, ours), (their_columns, theirs) = spark_rows, sql_rows
    if our_columns != their_columns:
        return f"columns {our_columns} != {their_columns}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b and not all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        ):
            return f"{dict(zip(our_columns, a))} != {dict(zip(our_columns, b))}"
    return None


def compare(spark, con, name, folder) -> str | None:
    import __spark_entry__ as entry

    rows = entry.queries()[name](spark, folder)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    for join in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        if join in plan:
            return f"the plan has a {join}"
    found = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    ours = [tuple(row) for row in rows.collect()]
    return difference(sorted_rows(rows.columns, ours), sorted_rows(columns, found.fetchall()))


if __name__ == "__main__":
    import __spark_entry__ as entry
    from conftest import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = local_session()
    folder = f"/root/testdata/sf{sf}"
    con = oracle(folder)
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        result = compare(spark, con, name, folder)
        print(f"{name:24} {time.time() - start:6.2f}s {result or 'equal'}", flush=True)
