"""Every registered query with an oracle vs DuckDB on the smallest scale factor."""

import math

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for tb in TABLES:
        c.execute(f"CREATE VIEW {tb} AS SELECT * FROM read_parquet('{SF_SMALL}/{tb}.parquet')")
    return c


def norm(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(ORACLES[name])
    ocols = [d[0] for d in rel.description]
    exp = rows(ocols, rel.fetchall())
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(exp)
    assert got == exp


@pytest.mark.parametrize("name", sorted(set(queries()) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    df = queries()[name](spark, SF_SMALL)
    assert df.count() > 0
    assert len(df.schema.fields) > 0


def test_entry(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["model", "testdata", "rmse", "mean_latency_ms", "n"]
    assert not math.isnan(df.first()["rmse"])
