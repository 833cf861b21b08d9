"""Comparing a query with its SQL twin, row by row."""

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, (str, int, datetime.datetime)):
        return v
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def rows_of(df):
    names = sorted(df.columns)
    return names, Counter(repr(tuple(map(plain, r))) for r in df.select(names).collect())


def rows_of_sql(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    names = sorted(con.sql(sql).columns)
    return names, Counter(repr(tuple(map(plain, r))) for r in con.sql(f"select {', '.join(chr(34) + n + chr(34) for n in names)} from ({sql})").fetchall())
