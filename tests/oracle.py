"""Compares a query with its DuckDB SQL."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir, sql):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def same(df, sf_dir, sql):
    names, rows = duck(sf_dir, sql)
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    pick = lambda r: tuple(round(r[c], 6) if isinstance(r[c], float) else r[c] for c in order)
    got = sorted((pick(r.asDict()) for r in df.collect()), key=repr)
    want = sorted((pick(dict(zip(names, r, strict=True))) for r in rows), key=repr)
    assert len(got) == len(want)
    assert got == want
