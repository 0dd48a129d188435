"""Run queries against their SQL: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.catalog import QUERIES, TABLES
from checks.oracle import ORACLE
from meterline.session import get_spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value) -> str:
    if isinstance(value, (list, tuple)) or hasattr(value, "tolist") and getattr(value, "ndim", 0) > 0:
        return str([_cell(v) for v in value])
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value) or value is pd.NA:
        return "NULL"
    if isinstance(value, bool) or type(value).__name__ in ("bool", "bool_"):
        return str(bool(value))
    if isinstance(value, (pd.Timestamp,)):
        return value.isoformat()
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, str):
        return value
    number = float(value)
    return repr(number)


def rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(map(_cell, row)) for row in ordered.itertuples(index=False, name=None))


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    left, right = rows(got), rows(want)
    if len(left) != len(right):
        extra = sorted(set(left) - set(right))[:2], sorted(set(right) - set(left))[:2]
        return f"{len(left)} rows != {len(right)} rows; {extra}"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_spark(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = duck(folder), 0
    for name in names:
        started = time.time()
        try:
            got = QUERIES[name](spark, folder).toPandas()
            took = time.time() - started
            want = connection.execute(ORACLE[name]).df() if name in ORACLE else None
            problem = None if want is None else difference(got, want)
            state = "rows only" if want is None else "ok" if problem is None else "DIFF"
        except Exception as exc:
            took, state, problem, got = time.time() - started, "ERROR", f"{type(exc).__name__}: {exc}"[:700], []
        failed += state in ("DIFF", "ERROR")
        print(f"{state:9} {name:24} {len(got):8} rows {took:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
