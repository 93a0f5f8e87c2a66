"""Every registered query of the measurement operators against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from assayloom.plans import alignment, harmony, inputs, models, people, quality, registry, relations, reports, tables  # noqa: F401

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"enet_cv", "model_zoo", "net_importance"}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 5) + 0.0 if isinstance(v, float) else v


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables here")
@pytest.mark.parametrize("name", sorted(set(registry.SQL)))
def test_against_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SMALL)
    got = sorted(repr([plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    rel = duck.execute(registry.SQL[name])
    names = [d[0] for d in rel.description]
    want = sorted(repr([plain(r[names.index(c)]) for c in sorted(names)]) for r in rel.fetchall())
    assert sorted(names) == sorted(df.columns)
    assert got == want


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables here")
@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL) - SLOW))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert {"sample_technical_stats"} <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert entry.entry(spark).columns
