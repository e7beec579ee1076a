"""Queries beside their SQL on tables that show what the given ones do not."""

import duckdb
import pytest
from test_queries import TABLES, key

from quadrat.plans import catalog


@pytest.fixture
def equal(spark, sf_dir, tmp_path):
    """Whether a query gives what its SQL gives, where a table is replaced by the rows of a SELECT over the given ones."""

    def run(name, **tables):
        c = duckdb.connect()
        for t in TABLES:
            rows = tables.get(t, f"SELECT * FROM '{sf_dir}/{t}.parquet'")
            c.sql(f"COPY ({rows.format(d=sf_dir)}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
        got, want = catalog.QUERIES[name](spark, f"file://{tmp_path}"), c.sql(catalog.SQL[name])
        cols = sorted(got.columns)
        at = [want.columns.index(x) for x in cols]
        g = sorted(tuple(key(r[x]) for x in cols) for r in got.collect())
        assert g == sorted(tuple(key(r[i]) for i in at) for r in want.fetchall())

    return run


def test_mean_distance_of_more_than_4000_points(equal):
    equal("G06", embeddings="SELECT * REPLACE (vec_id + k * 100000 AS vec_id, [e + (k % 3) * 0.1 FOR e IN embedding] AS embedding) FROM '{d}/embeddings.parquet', range(9) r(k)")


def test_cubes_without_centre(equal):
    equal("S05", embeddings="SELECT * FROM '{d}/embeddings.parquet' WHERE vec_id % 75 <> 12")
