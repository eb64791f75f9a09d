"""Registered queries that SQL can state, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tripweave.llm import queries


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    told = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in told.description]
    assert set(names) == set(df.columns)
    expected = sorted(tuple(str(v) for v in r) for r in told.fetchall())
    assert sorted(tuple(str(v) for v in r) for r in df.select(*names).collect()) == expected
