"""Runs a query and its SQL on the same tables and compares rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def rows_of(frame) -> Counter:
    columns = sorted(frame.columns)
    return Counter(tuple(plain(r[c]) for c in columns) for r in frame.collect())


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if value.__class__.__name__ == "Decimal":
        return round(float(value), 6)
    return value


def sql_rows(sql: str, folder: Path) -> Counter:
    con = duckdb.connect()
    for p in folder.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p if p.is_file() else str(p) + '/*.parquet'}'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in found.fetchall())


def same(query, sql: str, spark, scale: str = "sf0.01") -> None:
    folder = DATA / scale
    frame = query(spark, str(folder))
    ours, theirs = rows_of(frame), sql_rows(sql, folder)
    assert ours == theirs, (sum(ours.values()), sum(theirs.values()), list((ours - theirs).items())[:3], list((theirs - ours).items())[:3])
