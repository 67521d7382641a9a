"""Every registered query with SQL gives the same rows as DuckDB on a small table set."""

import decimal

import duckdb
import pytest

import __spark_entry__
from helixframe.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(row):
    return tuple(float(x) if isinstance(x, decimal.Decimal) else x for x in row)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, SF)
    want = duck.execute(__spark_entry__.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, map(plain, got.select(*[f"`{c}`" for c in names]).collect()))) == sorted(map(repr, map(plain, want.fetchall())))


def test_entry_and_rows_only_queries(spark):
    assert __spark_entry__.entry(spark).count() > 0
    for name in sorted(catalogue.QUERIES.keys() - catalogue.ORACLE_SQL.keys()):
        assert catalogue.QUERIES[name](spark, SF).count() > 0
