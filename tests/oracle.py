"""Compare a registered query with its SQL twin, rows in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}" if v else "0"
    return repr(v)


def _rows(names: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns and rows agree, else a short account of the first difference."""
    names, got = _rows(df.columns, df.collect())
    cursor = con.execute(sql)
    wanted_names, wanted = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    for a, b in zip(got, wanted):
        if a != b:
            return f"{a} != {b}"
    return None
