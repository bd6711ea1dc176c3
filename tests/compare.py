"""Spark query against DuckDB SQL on the same tables: same columns, kinds of values and rows in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        db.execute(f"create view {os.path.basename(path).split('.')[0]} as select * from read_parquet('{files}')")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return bytes(value) if isinstance(value, bytearray) else value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def differences(frame, db, sql: str) -> str:
    got = rows_of(frame.columns, frame.collect())
    result = db.execute(sql)
    names = [c[0] for c in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} and {sorted(names)}"
    if got != want:
        return f"{len(got)} and {len(want)} rows; first others: {next(((a, b) for a, b in zip(got, want) if a != b), None)}"
    return ""
