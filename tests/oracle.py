"""Comparing a Spark result with DuckDB's, order apart."""

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.12g}")
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(plain(v) for v in x)
    return x


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def from_duckdb(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), rows(names, cur.fetchall())


def from_spark(df):
    return sorted(df.columns), rows(df.columns, [tuple(r) for r in df.collect()])
