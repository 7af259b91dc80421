"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's
order-insensitive check: same columns, same row count, same sorted rows)."""

from __future__ import annotations

import datetime as _dt
import math
import os

import duckdb

from estatelens.sources.roles import DRIVER_TABLES

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    import tempfile
    con = duckdb.connect()
    # spill into a fresh scratch folder, never into the working directory
    con.execute(f"SET temp_directory = '{tempfile.mkdtemp(prefix='duck-spill-')}'")
    # a runaway oracle plan fails fast instead of filling the disk
    con.execute("SET max_temp_directory_size = '4GB'")
    con.execute("SET memory_limit = '8GB'")
    for t in DRIVER_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, round(v, 6))
    if isinstance(v, bool):
        return (2, int(v))
    if isinstance(v, int):
        return (1, float(v)) if abs(v) < 2**53 else (1, v)
    if isinstance(v, _dt.datetime):
        return (3, v.replace(tzinfo=None).isoformat())
    if isinstance(v, _dt.date):
        return (3, _dt.datetime(v.year, v.month, v.day).isoformat())
    if hasattr(v, "__float__") and not isinstance(v, str):
        return (1, round(float(v), 6))
    return (4, str(v))


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect())


def rows_of_duck(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted(tuple(_norm(r[i]) for i in idx) for r in data)


_TYPE_MAP = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
             "smallint": "SMALLINT", "tinyint": "TINYINT", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_diff(df, con, sql):
    d = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for name, t in df.dtypes:
        want = _TYPE_MAP.get(t, t.upper())
        if d.get(name) != want and not (want == "VARCHAR" and d.get(name) == '"NULL"'):
            out.append(f"{name}: spark={t} duck={d.get(name)}")
    return out


def compare(df, con, sql, check_types=True):
    """Return None when equal, else a short description."""
    if check_types:
        td = type_diff(df, con, sql)
        if td:
            return "types differ: " + "; ".join(td)
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    if sc != dc:
        return f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return f"row count differs: spark={len(sr)} duck={len(dr)}"
    if sr != dr:
        for a, b in zip(sr, dr):
            if a != b:
                return f"first differing row: spark={a} duck={b}"
    return None
