"""Compares a query with its SQL on DuckDB: names, row counts and values in any order."""

import math
from pathlib import Path

import duckdb


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return float(f"{float(v):.9g}") if abs(v) < 2**53 else v
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir, sql):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        at = f"{p}/*.parquet" if p.is_dir() else p
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{at}')")
    out = con.execute(sql)
    return rows_of([c[0] for c in out.description], out.fetchall())


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def assert_same(df, sf_dir, sql):
    a, b = spark_rows(df), duck(sf_dir, sql)
    assert a[0] == b[0], (a[0], b[0])
    assert len(a[1]) == len(b[1]), (len(a[1]), len(b[1]))
    bad = [(x, y) for x, y in zip(a[1], b[1], strict=True) if x != y]
    assert not bad, (len(bad), bad[:3])
