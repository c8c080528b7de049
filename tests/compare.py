"""Run the catalogue against DuckDB: ``python tests/compare.py SF_DIR [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value) + 0.0)
    return str(value)


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def differences(spark, con, sf_dir: str, name: str) -> tuple[str | None, int]:
    """What differs between a query and its oracle (None if nothing), and the number of rows."""
    import __spark_entry__ as entry

    got = entry.queries()[name](spark, sf_dir)
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(columns)}", 0
    expected = sorted_rows(columns, result.fetchall())
    actual = sorted_rows(got.columns, [tuple(r) for r in got.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}", len(actual)
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(actual)} rows differ, e.g. {wrong[0]}", len(actual)
    return None, len(actual)


def main() -> int:
    import __spark_entry__ as entry
    from gridmend.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(entry.queries())
    spark, con, failed = local_session(), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem, n = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", 0
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok'} {name} rows={n} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed of {len(names)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
