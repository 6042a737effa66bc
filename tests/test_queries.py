import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry_points
from turnmill.plans.catalog import QUERIES as OWN

TABLES = ["documents", "conversations", "benchmark", "labels"]
QUERIES = entry_points.queries()
# The corpus queries are compared in their own tests.
ORACLE = {name: sql for name, sql in entry_points.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    frame = frame.astype(object).where(frame.notna(), None)
    return sorted((tuple(r) for r in frame.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(ORACLE[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_is_registered_once():
    assert set(ORACLE) <= set(QUERIES)
    assert set(OWN) - set(ORACLE) == {"dedup_near", "flagship"}
