"""Every registered query against its SQL oracle in DuckDB, on the smallest data set."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from clicktrail.plans import oracles, registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("nation", "customer", "part", "events")
QUERIES = registry.all_queries()
ORACLES = oracles.oracle_sql(horizon=registry.REPORT_HORIZON, keep=registry.KEEP, lateness=registry.LATENESS)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    got = canonical(result.columns, [tuple(row) for row in result.collect()])
    answer = duck.execute(ORACLES[name])
    columns = [column[0] for column in answer.description]
    want = canonical(columns, answer.fetchall())
    assert sorted(result.columns) == sorted(columns)
    assert got == want


def test_reports_come_back_in_order(spark):
    counts = [row["count"] for row in QUERIES["report_sources"](spark, SF_DIR).collect()]
    assert counts == sorted(counts, reverse=True)
    times = [row.time for row in QUERIES["report_revenue"](spark, SF_DIR).collect()]
    assert times == sorted(times)


def test_entry_attributes_each_purchase_at_most_once(spark):
    flagship = driver.entry(spark)
    assert flagship.count() == flagship.select("purchase_id").distinct().count() == 71
