"""Compare Spark results with the SQL counterparts, ignoring row order."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = ("conversations", "benchmark")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normalise(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)].astype(object)
    pdf = pdf.where(pdf.notna(), None)
    return pdf.sort_values(list(pdf.columns), key=lambda c: c.map(repr)).reset_index(drop=True)


def differences(actual: pd.DataFrame, expected: pd.DataFrame) -> str:
    a, e = normalise(actual), normalise(expected)
    if list(a.columns) != list(e.columns):
        return f"columns {list(a.columns)} != {list(e.columns)}"
    if len(a) != len(e):
        return f"rows {len(a)} != {len(e)}"
    for column in a.columns:
        differing = [i for i in range(len(a)) if a.at[i, column] != e.at[i, column]]
        if differing:
            i = differing[0]
            return f"{column}: {len(differing)} rows differ, e.g. {a.at[i, column]!r} != {e.at[i, column]!r}"
    return ""
