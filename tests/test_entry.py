"""Registered queries against their SQL at the smallest scale."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from textloom.plans import catalogue

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables here")
@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        db.execute(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    key = lambda df: sorted(tuple(f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None))
    got, want = catalogue.QUERIES[name](spark, DIR).toPandas(), db.execute(catalogue.ORACLE_SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns) and key(got) == key(want)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    if os.path.isdir(DIR):
        assert entry.entry(spark).count() > 0
