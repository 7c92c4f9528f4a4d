"""Spark results against DuckDB on the same files."""

import glob
import os

import duckdb


def connection(sf_dir):
    c = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    return c


def _value(x):
    if x is None or str(x) in ("nan", "<NA>", "NaT"):
        return None
    kind = type(x).__name__
    if kind.startswith(("int", "uint")):
        return float(x)
    return round(float(x), 6) if kind.startswith("float") else x


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(([_value(v) for v in r] for r in frame.itertuples(index=False)), key=lambda r: [(v is None, str(v)) for v in r])


def same(df, sql, sf_dir):
    a, b = df.toPandas(), connection(sf_dir).execute(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)
