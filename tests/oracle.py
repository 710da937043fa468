"""Row-by-row comparison of a Spark frame with DuckDB's answer."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return bytes(v) if isinstance(v, bytearray) else v


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(r[i]) for i in order]) for r in found)


def same(df, con, sql):
    want = con.sql(sql)
    columns = want.columns
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, want.fetchall())
