"""Comparison of a Spark query with its DuckDB twin."""

import os

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    return con


def rows(frame):
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, (float, np.floating)) and np.isnan(v)):
            return ""
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        if isinstance(v, (int, float, np.integer, np.floating)):
            return "%.9g" % float(v)
        return str(v)

    return sorted(tuple(plain(v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False))


def assert_same(spark, sf_dir, run, sql):
    ours, theirs = run(spark, sf_dir).toPandas(), duck(sf_dir).execute(sql).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
