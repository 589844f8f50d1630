"""Run a query and its SQL and compare the results."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _normal(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)]
    out = pd.DataFrame(index=pdf.index)
    for c in pdf.columns:
        col = pdf[c]
        if str(col.dtype).startswith("datetime"):
            col = col.dt.strftime("%Y-%m-%d %H:%M:%S.%f")
        elif col.dtype == object:
            col = col.map(lambda v: None if v is None or v is pd.NaT or v != v else str(v))
            col = col.map(lambda v: v[:10] if isinstance(v, str) and v.endswith(" 00:00:00") else v)
        elif str(col.dtype).startswith("int") or str(col.dtype).startswith("uint"):
            col = col.astype("int64")
        out[c] = col
    for c in out.columns:
        if out[c].dtype == object and out[c].map(lambda v: isinstance(v, str) and v.endswith(" 00:00:00.000000")).all():
            out[c] = out[c].str[:10]
    return out.sort_values(list(out.columns), na_position="first", ignore_index=True)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> None:
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want), f"{len(got)} rows, SQL has {len(want)}"
    assert len(want) > 0
    pd.testing.assert_frame_equal(_normal(got), _normal(want), check_dtype=False, rtol=0, atol=0)
