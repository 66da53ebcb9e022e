"""Run registered queries and their SQL over the same files and compare all values exactly.

    python tests/compare.py [directory] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark_df, con: duckdb.DuckDBPyConnection, text: str) -> str | None:
    """None if both sides hold the same rows."""
    mine = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(text)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns differ: {sorted(set(names) ^ set(spark_df.columns))}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows, expected {len(theirs)}"
    columns = sorted(names)
    for a, b in zip(mine, theirs):
        if a != b:
            odd = {c: (x, y) for c, x, y in zip(columns, a, b) if x != y}
            return f"differing row: {odd} in {dict(zip(columns, b))}"
    kinds = [(c, type(x), type(y)) for a, b in zip(mine, theirs) for c, x, y in zip(columns, a, b)]
    bad = sorted({c for c, x, y in kinds if x is not y})
    return f"types differ: {bad}" if bad else None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.conftest import session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con, failed = session(), connect(sf_dir), 0
    for name, make in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        began = time.time()
        text = entry.oracle_sql().get(name)
        try:
            odd = differences(make(spark, sf_dir), con, text) if text else f"no SQL: {make(spark, sf_dir).count()} rows"
        except Exception as problem:
            odd = f"{type(problem).__name__}: {str(problem)[:700]}"
        failed += bool(odd and text)
        print(f"{name:34} {time.time() - began:6.2f}s  {odd or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
