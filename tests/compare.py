"""Compare each named query with its SQL statement, row by row.

Run as a script with a table folder and, optionally, query names.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_rows(sf_dir: str, statement: str) -> tuple[list[tuple[str, str]], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    result = con.execute(statement)
    columns = [(d[0], str(d[1])) for d in result.description]
    return columns, result.fetchall()


def _value(v):
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, Decimal):
        return float(v)
    return v


def _bag(names: list[str], rows: list) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


_KIND = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def difference(df, sf_dir: str, statement: str) -> str | None:
    """None if the frame equals the statement's result, else what differs."""
    columns, expected = sql_rows(sf_dir, statement)
    actual = df.collect()
    names = [c for c, _ in columns]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    got, want = _bag(df.columns, actual), _bag(names, expected)
    types = {c: t for c, t in columns}
    wrong = [f"{c}: {t} / {types[c]}" for c, t in df.dtypes if _KIND.get(t, t) != types[c]]
    if got != want:
        missing, extra = list((want - got).items()), list((got - want).items())
        return f"{len(missing)} missing e.g. {missing[:2]}; {len(extra)} extra e.g. {extra[:2]}; types {wrong}"
    return f"types {wrong}" if wrong else None


def main() -> int:
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from tests.session import local_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = local_session()
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in chosen or queries:
        started = time.perf_counter()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                problem = difference(df, sf_dir, oracle[name])
            else:
                problem = f"no statement; {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{time.perf_counter() - started:6.1f}s {name}: {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
