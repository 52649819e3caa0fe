"""Compare registered queries with their SQL on the driver tables."""

from __future__ import annotations

import os
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(folder, name)}.parquet'")
    return con


def _canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if frame[c].dtype.kind == "f":
            frame[c] = frame[c].map(lambda v: None if v != v else repr(float(v)))
        else:
            frame[c] = frame[c].map(lambda v: None if v is None or v is pd.NaT or v != v else
                                    repr(list(v)) if hasattr(v, "__len__") and not isinstance(v, str) else str(v))
        frame[c] = frame[c].map(lambda v: "null" if v is None else v)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def compare(spark, con, run, sql: str, folder: str) -> tuple[str, float]:
    """Empty text if equal, else the difference; and the Spark seconds."""
    start = time.time()
    got = run(spark, folder).toPandas()
    took = time.time() - start
    want = con.execute(sql).fetch_df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}", took
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", took
    a, b = _canonical(got), _canonical(want)
    if not len(a):
        return "both sides are empty", took
    for c in a.columns:
        bad = a[c] != b[c]
        if bad.any():
            i = bad.idxmax()
            return f"{int(bad.sum())} differ in {c!r}; first {a.loc[i].to_dict()} != {b.loc[i].to_dict()}"[:1200], took
    return "", took
