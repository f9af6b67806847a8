"""Comparison of a query with its SQL in DuckDB, as multisets of rows."""

import math
import os
from collections import Counter

DATA = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return round(v, 6) if math.isfinite(v) else str(v)
    if isinstance(v, list | tuple) and not hasattr(v, "asDict"):
        return tuple(map(norm, v))
    if hasattr(v, "asDict"):
        v = v.asDict()
    return tuple(sorted((k, norm(x)) for k, x in v.items())) if isinstance(v, dict) else v


def compare(spark, name, query, sql, data=DATA):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in os.listdir(data):
        con.execute(f"create view {t[:-8]} as select * from '{data}/{t}'")
    df = query(spark, data)
    columns = sorted(df.columns)
    ours = Counter(repr([norm(r[c]) for c in columns]) for r in df.collect())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns, name
    theirs = Counter(repr([norm(row[names.index(c)]) for c in columns]) for row in found.fetchall())
    assert ours == theirs, (name, list((ours - theirs))[:2], list((theirs - ours))[:2])
