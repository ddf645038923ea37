"""Run the registered queries next to their DuckDB statements and compare the rows.

``python -m checks.compare [folder] [name prefix ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from checks.oracles import oracle_sql
from patronage.plans.registry import queries
from patronage.session import local_session


def plain(value):
    """A form in which equal values of both engines are equal."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def compare(spark, db, folder: str, name: str, statement: str | None) -> tuple[bool, str]:
    df = queries()[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    if statement is None:
        return len(got) > 0, f"{len(got)} rows, not compared"
    found = db.execute(statement)
    columns = [d[0] for d in found.description]
    want = rows_of(columns, found.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(columns)}"
    if repr(got) != repr(want):
        differing = [(a, b) for a, b in zip(got, want) if repr(a) != repr(b)][:2]
        return False, f"{len(got)} rows against {len(want)}: {differing}"
    return True, f"{len(got)} rows equal"


def main(folder: str = "/root/testdata/sf0.01", *prefixes: str) -> int:
    spark, db, statements = local_session(), connect(folder), oracle_sql()
    bad = 0
    for name in queries():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            ok, text = compare(spark, db, folder, name, statements.get(name))
        except Exception as problem:  # noqa: BLE001 - report and go on with the next query
            ok, text = False, f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28} {time.time() - start:6.1f}s  {text}", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
