"""Run registered queries against their SQL in DuckDB: ``python tests/oracle.py [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, int):
        return f"{float(v):.9g}" if abs(v) < 10**9 else str(v)
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str):
    """(ok, message) for one query."""
    from punctua.catalog import QUERIES, SQL

    start = time.time()
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if name not in SQL:
        return True, f"{len(got)} rows, no SQL, {took:.1f}s"
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = rows_of(columns, cur.fetchall())
    if got != want:
        diff = next(((a, b) for a, b in zip(got, want) if a != b), None)
        return False, f"{len(got)} rows, expected {len(want)}; first difference {diff}"
    return True, f"{len(got)} rows, {took:.1f}s"


if __name__ == "__main__":
    from punctua.catalog import QUERIES
    from punctua.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session()
    session.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), []
    for q in sys.argv[2:] or QUERIES:
        try:
            ok, text = compare(session, con, folder, q)
        except Exception as error:  # noqa: BLE001
            ok, text = False, f"{type(error).__name__}: {str(error)[:600]}"
        print("ok  " if ok else "FAIL", q, text, flush=True)
        bad += [] if ok else [q]
    print("failed:", bad)
