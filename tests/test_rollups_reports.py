import datetime as dt
from decimal import Decimal

import pytest

from clicktrail.operators import reports
from clicktrail.operators.retention import retain
from clicktrail.operators.rollups import COUNT_TABLES, count_by, rollup, rollup_cube, rollup_from_cube
from clicktrail.schemas import ROLLUPS
from helpers import NOON, at, rows


@pytest.fixture(scope="module")
def checkouts(spark):
    data = [
        ("success", "Google", "none", "TOYS", "F", at("12:00:00"), Decimal("10.5"), Decimal("1.25"), 2),
        ("success", "Google", "none", "TOYS", "M", at("12:00:59.999999"), Decimal("4.5"), Decimal("0.75"), 1),
        ("success", "Tiktok", "none", "BOOKS", "M", at("12:01:00"), Decimal("7"), Decimal("2"), 3),
        ("failure", "Gmail", "Card Expired", "TOYS", "F", at("12:00:30"), Decimal("99"), Decimal("9"), 9),
        ("success", "Gmail", "none", "TOYS", "F", None, Decimal("99"), Decimal("9"), 9),
    ]
    schema = (
        "payment_status STRING, source STRING, description STRING, category STRING, gender STRING, "
        "purchase_time TIMESTAMP, total_cost DECIMAL(24,8), profit DECIMAL(31,12), quantity BIGINT"
    )
    return spark.createDataFrame(data, schema).cache()


def test_counts_are_labelled_with_the_window_end(checkouts):
    assert rows(count_by(checkouts, "source", "success"), "source", "count", "time") == [
        ("Google", 2, at("12:01")),
        ("Tiktok", 1, at("12:02")),
    ]


def test_failures_count_by_reason(checkouts):
    assert rows(rollup(checkouts, "fail_count"), "description", "count", "time") == [
        ("Card Expired", 1, at("12:01"))
    ]


def test_revenue_ignores_failures_and_empty_windows(checkouts):
    assert rows(rollup(checkouts, "revenue"), "time", "revenue", "profit", "quantity") == [
        (at("12:01"), Decimal("15"), Decimal("2"), 3),
        (at("12:02"), Decimal("7"), Decimal("2"), 3),
    ]


@pytest.mark.parametrize("table", list(ROLLUPS))
def test_single_pass_equals_separate(checkouts, table):
    separate, single = rollup(checkouts, table), rollup_from_cube(rollup_cube(checkouts), table)
    assert separate.columns == single.columns == ROLLUPS[table].columns
    assert rows(separate) == rows(single)


def test_every_success_is_counted_once_per_dimension(checkouts):
    sums = {
        t: rows(rollup(checkouts, t).groupBy("time").sum("count"))
        for t, (status, _) in COUNT_TABLES.items()
        if status == "success"
    }
    assert len(sums) == 3 and len({str(s) for s in sums.values()}) == 1


def counted(spark, *data):
    return spark.createDataFrame(list(data), "category STRING, count BIGINT, time TIMESTAMP")


def test_horizon_includes_its_old_end(spark):
    hour, micro = dt.timedelta(hours=1), dt.timedelta(microseconds=1)
    table = counted(spark, ("a", 1, NOON), ("a", 2, NOON - hour), ("a", 4, NOON - hour - micro))
    assert rows(reports.totals(table, "category", NOON)) == [("a", 3)]
    assert rows(reports.totals(table, "category", reports.latest(table))) == [("a", 3)]


def test_top_categories_break_ties_by_name(spark):
    table = counted(spark, *[(f"c{i:02d}", 5, NOON) for i in range(12)], ("z", 9, NOON))
    top = [r.category for r in reports.report_top_categories(table, NOON).collect()]
    assert top == ["z", *[f"c{i:02d}" for i in range(9)]]


def test_gender_shares_sum_to_one(spark):
    table = counted(spark, ("F", 3, NOON), ("M", 1, NOON)).withColumnRenamed("category", "gender")
    assert rows(reports.report_gender(table, NOON), "gender", "count", "share") == [("F", 3, 0.75), ("M", 1, 0.25)]


def test_revenue_series_is_ordered_and_optionally_bounded(spark):
    one = Decimal(1)
    data = [(2 * one, one, 1, at("12:00")), (one, one, 1, at("10:00")), (3 * one, one, 1, at("11:30"))]
    table = spark.createDataFrame(data, ROLLUPS["revenue"].schema)
    assert [r.revenue for r in reports.report_revenue(table).collect()] == [1.0, 3.0, 2.0]
    assert [r.revenue for r in reports.report_revenue(table, NOON).collect()] == [3.0, 2.0]


def test_retention_keeps_rows_of_exactly_the_horizon(spark):
    age = dt.timedelta(days=2)
    table = counted(spark, ("kept", 1, NOON - age), ("gone", 1, NOON - age - dt.timedelta(microseconds=1)))
    once = retain(table, NOON)
    assert rows(once, "category") == [("kept",)]
    assert rows(retain(once, NOON)) == rows(once)
