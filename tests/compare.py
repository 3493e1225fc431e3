"""Side-by-side comparison of registered queries with their SQL, run by DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

WHOLESALE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

_FAMILY = {
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in WHOLESALE:
        path = Path(folder) / f"{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else x + 0.0
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, dt.datetime):
        return x.date()
    return x


def _sortable(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=_sortable
    )


def difference(df, con, sql) -> str | None:
    """None when equal; otherwise a short account of the first difference."""
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    types = {d[0]: _FAMILY.get(str(d[1]), str(d[1])) for d in res.description}
    cols_o, rows_o = normal(names, res.fetchall())
    cols_s, rows_s = normal(df.columns, [tuple(r) for r in df.collect()])
    if cols_s != cols_o:
        return f"columns {cols_s} != {cols_o}"
    mine = dict(df.dtypes)
    off = {c: (mine[c], types[c]) for c in cols_s if mine[c] != types[c]}
    if off:
        return f"types {off}"
    if len(rows_s) != len(rows_o):
        return f"{len(rows_s)} rows != {len(rows_o)}"
    bad = [(a, b) for a, b in zip(rows_s, rows_o) if a != b]
    if bad:
        return f"{len(bad)} of {len(rows_s)} rows differ, first {bad[0]}"
    return None
