"""Every registered query beside its SQL equivalent on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as driver
from ledgerflow.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return "\0null" if value is None else str(value)


def comparable(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(row[i]) for i in order) for row in found)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, tables, name):
    df = driver.queries()[name](spark, sf_dir)
    found = [tuple(r) for r in df.collect()]
    assert found, "a query over whole tables returns rows"
    result = tables.execute(driver.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert comparable(df.columns, found) == comparable(names, result.fetchall())


def test_entry(spark, sf_dir):
    df = driver.entry(spark)
    assert df.columns == ["c_mktsegment", "o_orderpriority", "total_amount", "order_count"]
    assert df.count() > 0
