"""Holds queries against their SQL on the driver's small tables."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

SF = "/root/testdata/sf0.001"


def connect(sf: str = SF):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 4)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def compare(spark, query, sql: str, sf: str = SF) -> None:
    df = query(spark, sf)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    rel = connect(sf).execute(sql)
    names = [x[0] for x in rel.description]
    assert sorted(names) == cols
    exp = Counter(tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert got == exp, (list((got - exp).items())[:2], list((exp - got).items())[:2])
