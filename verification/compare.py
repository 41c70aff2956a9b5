"""Run registered queries next to their checking SQL: python -m verification.compare [sf_dir] [name ...]."""

from __future__ import annotations

import sys
import tempfile
import time

import duckdb
import pandas as pd

from factorfall.session import build_session
from verification.oracle import oracle_sql
from verification.queries import queries
from verification.views import GIVEN


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, cells as comparable text, rows in order."""
    out = {}
    for c in sorted(df.columns):
        column = df[c]
        out[c] = [
            "null" if pd.isna(v) else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
            for v in column.astype(object)
        ]
    frame = pd.DataFrame(out)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in GIVEN:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str:
    """Empty when equal, else what differs first."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(set(spark_rows.columns) ^ set(sql_rows.columns))}"
    a, b = normal(spark_rows), normal(sql_rows)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    if a.equals(b):
        return ""
    unequal = (a != b).any(axis=1)
    first = unequal.idxmax()
    shown = [(c, a.at[first, c], b.at[first, c]) for c in a.columns if a.at[first, c] != b.at[first, c]]
    return f"{int(unequal.sum())} of {len(a)} rows, first: {shown}"


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="staging-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, failed = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            rows = query(spark, sf_dir).toPandas()
            seconds = time.time() - start
            start = time.time()
            expected = con.execute(checks[name]).df() if name in checks else None
            verdict = "no SQL" if expected is None else difference(rows, expected) or "equal"
        except Exception as error:  # report and go on to the next query
            rows, seconds, verdict = [], time.time() - start, f"error {str(error)[:600]}"
        failed += verdict not in ("equal", "no SQL")
        print(f"{name}: {verdict} ({len(rows)} rows, {seconds:.2f}s, sql {time.time() - start:.2f}s)", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
