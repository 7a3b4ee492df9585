"""Run catalog queries and their SQL side by side. ``python tests/compare.py FOLDER [name ...]`` prints one line each."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def oracle_connection(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normalised(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, numbers as floats, rows sorted: order and integer width do not matter."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype(str)
        elif pd.api.types.is_numeric_dtype(df[c]):
            df[c] = df[c].astype("float64") + 0.0
        else:
            df[c] = df[c].astype("object").where(df[c].notna(), None)
    return df.sort_values(list(df.columns), na_position="last", kind="stable").reset_index(drop=True)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    """``None`` when equal, otherwise what differs."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    a, b = normalised(spark_rows), normalised(sql_rows)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            at = same[~same].index[0]
            return f"{c}: {int((~same).sum())} values differ, first {a[c][at]!r} / {b[c][at]!r}"
    return None


def main(folder: str, names: list[str]) -> int:
    from shelfwise.catalog.oracle import ORACLE
    from shelfwise.catalog.queries import CATALOG
    from shelfwise.session import local_session

    spark, con, wrong = local_session(cores=8), oracle_connection(folder), 0
    for name in names or CATALOG:
        began = time.time()
        try:
            got = CATALOG[name](spark, folder).toPandas()
            spent = time.time() - began
            if name in ORACLE:
                began = time.time()
                problem = difference(got, con.execute(ORACLE[name]).df())
                verdict = f"sql {time.time() - began:.2f}s " + ("equal" if problem is None else f"DIFFERS {problem}")
            else:
                problem, verdict = None, "no sql"
        except Exception as error:  # report and go on
            spent, problem, verdict = time.time() - began, str(error), f"ERROR {type(error).__name__} {str(error)[:600]}"
        wrong += problem is not None
        print(f"{name:28s} {spent:6.2f}s rows={len(got) if 'got' in dir() else '?'} {verdict}", flush=True)
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
