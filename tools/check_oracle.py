"""Runs every report in Spark and its SQL twin in DuckDB and compares the rows.

    python tools/check_oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from shopledger.plans.oracle import ORACLE_SQL  # noqa: E402
from shopledger.plans.queries import QUERIES  # noqa: E402
from shopledger.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES.split():
        path = f"{folder}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, folder: str, name: str) -> list[str]:
    """Differences between both engines; empty if they agree."""
    df = QUERIES[name](spark, folder)
    got = df.collect()
    result = connection.execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} / {sorted(columns)}"]
    left, right = canonical(df.columns, got), canonical(columns, expected)
    if left == right:
        return []
    only_left = sorted(set(left) - set(right))[:3]
    only_right = sorted(set(right) - set(left))[:3]
    return [f"rows {len(left)} / {len(right)}; columns {sorted(columns)}", f"spark {only_left}", f"sql {only_right}"]


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, connection = local_session(cores="8"), connect(folder)
    failures = 0
    for name in names:
        if name not in ORACLE_SQL:
            print(f"{name}: no SQL")
            continue
        begun = time.time()
        try:
            differences = compare(spark, connection, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next one
            differences = [str(error)[:500]]
        failures += bool(differences)
        print(f"{name}: {'ok' if not differences else 'DIFF'} {time.time() - begun:.1f}s", flush=True)
        for line in differences:
            print("   ", line[:900], flush=True)
    print(f"{failures} of {len(names)} differ")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
