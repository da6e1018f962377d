"""Compares a query with its SQL on DuckDB."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}/*.parquet' )" if os.path.isdir(p) else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(v):
        if isinstance(v, float):
            return repr(round(v, 6) + 0.0)
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, int):
            return str(v)
        return str(v)

    return sorted(tuple(text(r[i]) for i in order) for r in values)


def same(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = connect(sf_dir).execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = rows(names, cur.fetchall())
    assert len(got) == len(want)
    assert [g for g in got if g not in set(want)][:3] == []
    assert got == want
