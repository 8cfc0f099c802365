"""Queries of this subpackage against their SQL in DuckDB."""

import duckdb
import pytest

from tests.test_oracle import TABLES, plain
from tierflow.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, sf, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    cursor = duck.execute(queries.ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str) == want


def test_a_query_for_every_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
