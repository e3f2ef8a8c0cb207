"""Every registered query against its SQL, on the smallest tables."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF
from stratafold.plans import star_queries
from stratafold.plans.star_schema import TABLES


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, Decimal):
        return str(value)
    return value


def ordered(rows, names):
    """Rows with their columns by name, in an order that allows for NULL."""
    by_name = sorted(range(len(names)), key=names.__getitem__)
    found = [tuple(plain(row[i]) for i in by_name) for row in rows]
    return sorted(found, key=lambda row: [(v is not None, str(v)) for v in row])


def test_all_queries_have_sql():
    assert star_queries.QUERIES.keys() == star_queries.SQL.keys()
    assert star_queries.QUERIES.items() <= entry.queries().items()


@pytest.mark.parametrize("name", list(star_queries.QUERIES))
def test_query_matches_its_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    relation = db.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    found, want = ordered(df.collect(), df.columns), ordered(relation.fetchall(), relation.columns)
    assert len(want) > 0
    assert found == want


def test_entry(spark):
    assert entry.entry(spark).count() == 24
