"""Run registered queries on Spark and their oracles on DuckDB and compare rows, names and value kinds.

usage: python tools/check.py [folder] [name-prefix ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from granero.schemas import TABLES  # noqa: E402
from granero.session import local_session  # noqa: E402
from granero.suite import QUERIES, oracle_text, run  # noqa: E402


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None or value != value:
        return "NULL"
    if isinstance(value, float):
        return f"{value + 0.0:.10g}"
    return str(value)


def normalised(names, rows):
    """Columns by name, the Python types seen in each, and the rows as sorted text."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    kinds = [sorted({type(r[i]).__name__ for r in rows if r[i] is not None}) for i in order]
    return [names[i] for i in order], kinds, sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(entry, spark, connection, folder) -> tuple[bool, str]:
    df = run(entry, spark, folder)
    got = [tuple(r) for r in df.collect()]
    text = oracle_text(entry)
    if text is None:
        return len(got) > 0, f"{len(got)} rows (no oracle)"
    cursor = connection.execute(text)
    left = normalised(df.columns, got)
    right = normalised([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return False, f"columns {left[0]} != {right[0]}"
    if left[1] != right[1]:
        return False, f"kinds {[(c, x, y) for c, x, y in zip(left[0], left[1], right[1]) if x != y]}"
    if left[2] != right[2]:
        only_left, only_right = set(left[2]) - set(right[2]), set(right[2]) - set(left[2])
        return False, (
            f"rows {len(left[2])} vs {len(right[2])}; {left[0]}\n   spark {sorted(only_left)[:2]}"
            f"\n   oracle {sorted(only_right)[:2]}"
        )
    return len(got) > 0, f"{len(got)} rows"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    prefixes = tuple(sys.argv[2:])
    spark, connection, bad = local_session("8"), oracle_connection(folder), []
    for name, entry in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            ok, note = compare(entry, spark, connection, folder)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        if not ok:
            bad.append(name)
        if not ok or os.environ.get("VERBOSE"):
            print(f"{'ok ' if ok else 'BAD'} {name:40s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{len(bad)} bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
