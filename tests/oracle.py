"""Compares a query with its SQL, as the driver does: columns by name, rows as a bag."""

import math
import os

import duckdb
import pyarrow as pa


def connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(os.listdir(sf_dir)):
        path = f"{sf_dir}/{f}" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/{f}") else "")
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.14g}")  # but for the last two of 16 digits
    if isinstance(x, list):
        return tuple(cell(y) for y in x)
    return x


def bag(t: pa.Table) -> list:
    names = sorted(t.column_names)
    rows = zip(*[t.column(n).to_pylist() for n in names]) if t.num_rows else []
    return sorted((tuple(cell(x) for x in r) for r in rows), key=repr)


def same(df, sql: str, sf_dir: str) -> tuple[int, list, list]:
    """Rows of the query; some that only the query has; some that only the SQL has."""
    from collections import Counter

    ours = df.toArrow()
    theirs = connection(sf_dir).sql(sql).arrow()
    theirs = theirs.read_all() if hasattr(theirs, "read_all") else theirs
    assert sorted(ours.column_names) == sorted(theirs.column_names), (ours.column_names, theirs.column_names)
    a, b = Counter(bag(ours)), Counter(bag(theirs))
    return ours.num_rows, list((a - b).items())[:5], list((b - a).items())[:5]
