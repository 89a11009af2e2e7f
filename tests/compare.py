"""Runs a query on Spark and its SQL on DuckDB over the same tables, and compares rows."""

import glob
import os

import duckdb

DATA = "/root/testdata/sf0.001"


def duck(sf_dir: str = DATA):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return str(v) if hasattr(v, "isoformat") else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


def compare(spark, f, sql: str, sf_dir: str = DATA):
    df = f(spark, sf_dir)
    got = rows(df.columns, df.collect())
    rel = duck(sf_dir).sql(sql)
    want = rows(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want), (len(got), len(want))
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert not wrong, (len(wrong), wrong[:3])
