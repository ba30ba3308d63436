"""Rows of a query and of its SQL, in a common form."""

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def rows(frame, columns):
    def form(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return "-"
        if isinstance(v, bool) or type(v).__name__ == "bool":
            return str(bool(v))
        if hasattr(v, "__float__") and not isinstance(v, str):
            return f"{float(v):.6g}"
        return str(v)

    return sorted(tuple(form(v) for v in r) for r in frame[columns].itertuples(index=False))


def same(spark_frame, sql_frame):
    columns = sorted(spark_frame.columns)
    assert columns == sorted(sql_frame.columns)
    a, b = rows(spark_frame, columns), rows(sql_frame, columns)
    assert len(a) == len(b)
    assert a == b, [(x, y) for x, y in zip(a, b) if x != y][:3]
