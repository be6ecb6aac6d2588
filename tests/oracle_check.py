"""Run registered queries and their SQL side by side: python tests/oracle_check.py [sf dir] [name ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region", "nation", "customer", "orders", "lineitem", "documents", "embeddings", "benchmark")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].round(6)
    return df.astype(object).where(df.notna(), None).sort_values(
        list(df.columns), key=lambda s: s.map(lambda v: (v is None, str(v)))
    ).reset_index(drop=True)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    got = canonical(entry.queries()[name](spark, sf_dir).toPandas())
    want = canonical(con.execute(entry.oracle_sql()[name]).df())
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} != {list(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for c in got.columns:
        unequal = got[c].map(str) != want[c].map(str)
        if unequal.any():
            at = unequal.idxmax()
            return f"{c}[{at}]: {got[c][at]!r} != {want[c][at]!r} ({int(unequal.sum())} rows)"
    return None


def main() -> int:
    from conftest import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), connect(sf_dir)
    names = sys.argv[2:] or list(entry.oracle_sql())
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
