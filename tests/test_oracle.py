"""Every registered query agrees with its DuckDB oracle on sf0.001."""
import math
import os

import pytest

import __spark_entry__ as E
from tidemark.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(_norm(x) for x in r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    want = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    assert sorted(rows, key=_key) == sorted(want, key=_key)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"ts_hour", "topic_id", "zscore", "rising_score"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
