"""Every registered query against its SQL in DuckDB."""

import math

import duckdb
import pytest

from tierflow import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "isoformat"):
        return str(v)
    return round(float(v), 6) if isinstance(v, int | float) or type(v).__name__ == "Decimal" else str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    cursor = duck.execute(registry.ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str) == want


def test_entry_without_the_subpackage():
    import subprocess
    import sys

    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'L10_by_year_failure' in e.queries() and 'pipeline' not in e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=str(__import__("pathlib").Path(__file__).parents[1]))
