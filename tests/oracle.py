"""Compares a registered query with its SQL in DuckDB."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool) or isinstance(v, str):
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return round(float(v), 8) + 0.0


def same(df, sql: str, sf_dir: str) -> None:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet{'/*.parquet' if os.path.isdir(f'{sf_dir}/{t}.parquet') else ''}')")
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    cols = sorted(df.columns)
    assert sorted(names) == cols
    key = lambda row: tuple((x is None, str(x)) for x in row)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=key)
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in cursor.fetchall()), key=key)
    assert got == want
