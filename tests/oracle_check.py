"""Compare a query with its SQL on the same tables, value by value."""

import math
import os

import duckdb


def connect(sf_dir):
    db = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        table = name.removesuffix(".parquet")
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    return db


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(float(value)) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(_cell(r[n]) for n in names) for r in df.collect())


def sql_rows(db, sql):
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, sorted(tuple(_cell(r[i]) for i in order) for r in result.fetchall())


def difference(df, db, sql):
    """None when equal, else a short description."""
    names, got = spark_rows(df)
    sql_names, want = sql_rows(db, sql)
    if names != sql_names:
        return f"columns {names} against {sql_names}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"row {mine} against {theirs}"
    return None
