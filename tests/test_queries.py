"""Every query with SQL gives what DuckDB gives; the others run and give rows."""

import datetime
import math

import duckdb
import pytest

from quadrat.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def key(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_sql(spark, sf_dir, duck, name):
    got, want = catalog.QUERIES[name](spark, sf_dir), duck.sql(catalog.SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    g = sorted(tuple(key(r[c]) for c in cols) for r in got.collect())
    at = [want.columns.index(c) for c in cols]
    w = sorted(tuple(key(r[i]) for i in at) for r in want.fetchall())
    assert len(g) == len(w) and [x for x in zip(g, w) if x[0] != x[1]][:5] == []


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0
