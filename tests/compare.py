"""Compare a Spark frame with a DuckDB query over the same tables."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, text):
    cur = con.execute(text)
    return rows_of([c[0] for c in cur.description], cur.fetchall())


def assert_same(df, con, text):
    got_names, got = spark_rows(df)
    want_names, want = sql_rows(con, text)
    assert got_names == want_names
    assert len(got) == len(want), (len(got), len(want))
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert not wrong, (got_names, len(wrong), wrong[:2])
    return len(got)
