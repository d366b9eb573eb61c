"""Compares a query with its SQL over the same parquet tables."""

import os

import duckdb
import pandas as pd

SMALL = "/root/testdata/sf0.001"


def _value(v):
    if isinstance(v, (list, dict)):
        return str(v)
    if pd.isna(v):
        return None
    if isinstance(v, float):
        return round(v, 5)
    return str(v) if hasattr(v, "year") else v


def _rows(df):
    df = df[sorted(df.columns)]
    return sorted(([_value(v) for v in r] for r in df.itertuples(index=False, name=None)), key=lambda r: [(x is None, str(x)) for x in r])


def compare(spark, query, sql, sf_dir=SMALL):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"create view {name[:-8]} as select * from read_parquet('{sf_dir}/{name}')")
    ours, theirs = query(spark, sf_dir).toPandas(), con.sql(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert _rows(ours) == _rows(theirs)
