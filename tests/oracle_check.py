"""Run registered queries next to their SQL counterparts and report differences."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by content, so that order does not matter."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]").astype(str)
        elif df[c].dtype.kind in "iub" or str(df[c].dtype) in ("Int64", "Int32", "boolean"):
            df[c] = df[c].astype(object)
        df[c] = df[c].map(lambda v: None if v is None or v is pd.NA or v != v else v)
    rows = df.map(repr)
    return rows.sort_values(list(rows.columns)).reset_index(drop=True)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns differ: {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows differ: {len(got)} / {len(want)}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        bad = a[c] != b[c]
        if bad.any():
            i = bad.idxmax()
            return f"{int(bad.sum())} values differ in {c}: {a[c][i]} / {b[c][i]}\n    {a.loc[i].to_dict()}\n    {b.loc[i].to_dict()}"
    return "ok"


def main() -> None:
    import __spark_entry__ as entry

    from terraloom.session import build_session

    sf = f"/root/testdata/sf{sys.argv[1]}"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(sf), entry.oracle_sql(), 0
    for name in names:
        started = time.monotonic()
        try:
            got = entry.queries()[name](spark, sf).toPandas()
            spent = time.monotonic() - started
            verdict = "no oracle" if name not in oracle else compare(got, con.execute(oracle[name]).df())
            rows = len(got)
        except Exception as problem:
            spent, rows, verdict = time.monotonic() - started, -1, f"{type(problem).__name__}: {str(problem)[:700]}"
        failed += verdict not in ("ok", "no oracle")
        print(f"{name:24s} {spent:7.2f}s {rows:8d} rows  {verdict}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
