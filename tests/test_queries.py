"""Every registered query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tripweave.plans import oracle, registry

from .conftest import SF

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
QUERIES, SQL = registry.queries(), oracle.statements()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return "\0" if v is None else str(v)


def _rows(rows, order):
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def test_sql_names_known_queries():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.execute(SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(names)
    cols = sorted(names)
    got = _rows(df.collect(), [df.columns.index(c) for c in cols])
    assert got == _rows(rel.fetchall(), [names.index(c) for c in cols])


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 24 and sum(r.trip_count for r in rows) == 167
