"""Comparison of queries with their SQL, the way the driver does it."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(columns, records):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(str([r[i] for i in order]) for r in records)


def assert_same(frame, con, sql):
    want = con.sql(sql)
    assert sorted(frame.columns) == sorted(want.columns)
    assert rows(frame.columns, frame.collect()) == rows(want.columns, want.fetchall())
