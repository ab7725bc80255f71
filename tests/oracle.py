"""Run a registered query and its SQL text on the same tables and compare all rows.

``python -m tests.oracle [folder] [query ...]`` checks from the command line.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
    "DECIMAL(18,2)": "decimal(18,2)",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark frame and a SQL result; empty when they agree."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    types = {d[0]: SPARK_TYPES.get(str(d[1]), str(d[1])) for d in expected.description}
    found_types = dict(frame.dtypes)
    if found_types != types:
        return [f"columns differ: {found_types} vs {types}"]
    want = _bag(names, expected.fetchall())
    got = _bag(frame.columns, frame.collect())
    missing, extra = want - got, got - want
    if not missing and not extra:
        return []
    return [
        f"rows {sum(got.values())} vs {sum(want.values())}",
        *[f"missing {row!r}"[:600] for row in list(missing)[:3]],
        *[f"extra   {row!r}"[:600] for row in list(extra)[:3]],
    ]


def main(arguments: list[str]) -> int:
    from snapdelta.queries import ORACLES, QUERIES
    from tests.conftest import make_session

    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:] or list(QUERIES)
    spark, connection, failed = make_session(), connect(folder), 0
    for name in wanted:
        start = time.monotonic()
        try:
            frame = QUERIES[name](spark, folder)
            problems = differences(frame, connection, ORACLES[name]) if name in ORACLES else []
            note = "" if name in ORACLES else f"rows only: {frame.count()}"
        except Exception as error:
            problems, note = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':5}{name:32}{time.monotonic() - start:7.2f}s {note}", flush=True)
        for problem in problems:
            print("     ", problem)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
