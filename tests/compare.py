"""Rows of a query against those of its SQL in DuckDB."""

import datetime
import decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, decimal.Decimal)):
        return float(v)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows(df):
    return sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=str)


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), sorted((tuple(plain(dict(zip(names, r))[c]) for c in sorted(names)) for r in cur.fetchall()), key=str)
