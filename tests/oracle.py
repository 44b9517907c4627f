"""Holds a query's rows against its SQL, run by DuckDB on the same tables."""

import os

import duckdb


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, list | tuple):
        return tuple(map(plain, value))
    return value if isinstance(value, int | str | bool | type(None)) else str(value)


def database(folder):
    con = duckdb.connect()
    for file in os.listdir(folder):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{folder}/{file}'")
    return con


def compare(spark, folder, query, sql, con):
    df = query(spark, folder)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=str)
    assert got == want
    return len(got)
