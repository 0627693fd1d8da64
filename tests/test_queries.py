"""Every registered query of the engine against its SQL, on the smallest data folder."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from sparkloom.plans.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else int(v) if v == int(v) and abs(v) < 1e15 else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() if isinstance(v, datetime.date) else v


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip("no data folder")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in ORACLE:
        assert got
        return
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted((tuple(norm(x[i]) for i in at) for x in rel.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).columns == ["source", "term", "tf", "df", "rank"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
