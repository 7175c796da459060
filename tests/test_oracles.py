"""Every registered query of the reference operators against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from quotelake.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows_of(rows, columns):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(repr(r[i]) for i in at) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = df.collect()
    relation = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert rows_of(got, df.columns) == rows_of(relation.fetchall(), relation.columns)
