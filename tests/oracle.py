"""A query's rows against its SQL's, on the same files."""

from pathlib import Path

import duckdb


def connect(sf):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def same(spark, con, sf, query, sql):
    df = query(spark, sf)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(columns).collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in at)) for r in result.fetchall())
    assert got == want
