"""Run registered queries against their SQL in DuckDB and compare whole results.

``python tests/oracle_check.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    """Rows with columns by name, cells as text, sorted."""

    def text(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return ""
        if isinstance(v, float):
            return repr(v)
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        if isinstance(v, dt.date):  # the other engine hands dates over as midnights
            return f"{v.isoformat()}T00:00:00"
        return str(v)

    pdf = pdf[sorted(pdf.columns)]
    out = []
    for c in pdf.columns:
        column = pdf[c]
        if str(column.dtype).startswith("datetime64"):
            column = column.astype("datetime64[us]")
        out.append([text(v) for v in column.tolist()])
    return sorted(zip(*out)) if out else []


def compare(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} != {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return f"rows {len(spark_pdf)} != {len(sql_pdf)}"
    a, b = canonical(spark_pdf), canonical(sql_pdf)
    if a == b:
        return None
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(diff)} rows differ, first: {diff[0]}"


def main() -> int:
    import __spark_entry__ as entry
    from conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = make_session()
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    failed = 0
    for name in names:
        start = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in sql:
                print(f"rows-only {name}: {len(got)} rows {took:.2f}s", flush=True)
                continue
            wrong = compare(got, con.sql(sql[name]).df())
        except Exception as error:  # noqa: BLE001
            wrong, took, got = f"{type(error).__name__}: {str(error)[:400]}", 0.0, []
        failed += wrong is not None
        print(f"{'ok  ' if wrong is None else 'FAIL'} {name}: {len(got)} rows {took:.2f}s"
              + (f"  {wrong}" if wrong else ""), flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
