"""Compares queries with their DuckDB SQL on the same tables."""

import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet({sorted(glob.glob(path + '/*.parquet')) if os.path.isdir(path) else [path]})")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return [names[k] for k in order], sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


def differences(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    cur = con.execute(sql)
    want = rows([d[0] for d in cur.description], cur.fetchall())
    if got == want:
        return None
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    a, b = set(got[1]), set(want[1])
    return f"{len(got[1])} rows and {len(want[1])}; only here {list(a - b)[:3]}, only there {list(b - a)[:3]}"
