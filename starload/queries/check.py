"""Compare registered queries with their SQL, run by DuckDB over the same files.

``python -m starload.queries.check <folder> [name ...]``
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

import starload.queries.all  # noqa: F401
from starload.queries.registry import ORACLES, QUERIES
from starload.session import build_session

_SAME = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def compare(spark: SparkSession, con, folder: str, name: str) -> str | None:
    """None if the query equals its SQL, else what differs."""
    df = QUERIES[name](spark, folder)
    types = dict(df.dtypes)
    columns = sorted(types)
    rows = [tuple(row) for row in df.select(*columns).collect()]
    if name not in ORACLES:
        return None
    relation = con.sql(ORACLES[name])
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    if sorted(expected_types) != columns:
        return f"columns {columns} but SQL has {sorted(expected_types)}"
    wrong = {c: (types[c], expected_types[c]) for c in columns if _SAME.get(types[c]) != expected_types[c]}
    if wrong:
        return f"types {wrong}"
    expected = relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    if len(rows) != len(expected):
        return f"{len(rows)} rows but SQL has {len(expected)}"

    def order(values):
        return [(value is not None, str(value)) for value in values]

    for mine, theirs in zip(sorted(rows, key=order), sorted(expected, key=order)):
        if mine != theirs:
            return f"row {mine} but SQL has {theirs}"
    return None


def main(folder: str, names: list[str]) -> int:
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or list(QUERIES):
        started = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += problem is not None
        mark = "FAIL" if problem else ("ok" if name in ORACLES else "rows only")
        print(f"{name:45s} {time.time() - started:6.2f}s {mark} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
