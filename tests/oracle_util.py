"""Order-insensitive comparison of a Spark result with a DuckDB result (columns sorted by name)."""

import math
import os

import duckdb
import pandas as pd

from ledgerline.sources.tables import TABLES


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def collected(df):
    """All rows as Python objects: toPandas makes floats of long columns with nulls."""
    return pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    return v


def canon(pdf):
    cols = sorted(pdf.columns)
    rows = sorted(tuple(repr(_norm(x)) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None))
    return cols, rows
