"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return 0.0 if value == 0 else float(f"{value:.12g}")
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, Counter(tuple(plain(row[n]) for n in names) for row in frame.collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, Counter(tuple(plain(row[i]) for i in at) for row in cursor.fetchall())


def difference(frame, con, sql):
    """Empty when both give the same rows, else a short description."""
    left_names, left = spark_rows(frame)
    right_names, right = sql_rows(con, sql)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if left == right:
        return ""
    extra, lacking = left - right, right - left
    return (
        f"{sum(left.values())} vs {sum(right.values())} rows; "
        f"only spark {sum(extra.values())}: {sorted(extra.items(), key=repr)[:3]}; "
        f"only sql {sum(lacking.values())}: {sorted(lacking.items(), key=repr)[:3]}"
    )
