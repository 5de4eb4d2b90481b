"""Run a registered query and its SQL counterpart and compare them value by value."""

from __future__ import annotations

import math

import duckdb

from ferryline.sources.collections import COLLECTIONS


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in COLLECTIONS:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    listed = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(listed, key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(db, sql):
    cursor = db.execute(sql)
    return _rows([d[0] for d in cursor.description], cursor.fetchall())
