"""Runs a query and its SQL side by side and compares rows without order."""

from __future__ import annotations

import datetime
import decimal
import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    """A value in a form that both engines share."""
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return round(float(value), 6)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)[:19].removesuffix(" 00:00:00")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck_rows(sf_dir: str, sql: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    found = con.execute(sql)
    return rows_of([d[0] for d in found.description], found.fetchall())


def spark_rows(frame):
    return rows_of(frame.columns, frame.collect())
