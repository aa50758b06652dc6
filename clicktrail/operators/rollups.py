"""Per-window roll-ups of checkouts, labelled with the exclusive window end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = "1 minute"
SUCCESS, FAILURE = "success", "failure"

#: Count table -> (payment status it counts, dimension it counts by).
COUNT_TABLES: dict[str, tuple[str, str]] = {
    "source_count": (SUCCESS, "source"),
    "fail_count": (FAILURE, "description"),
    "category_count": (SUCCESS, "category"),
    "gender_count": (SUCCESS, "gender"),
}

CUBE_DIMENSIONS = ("payment_status", "source", "description", "category", "gender")


def with_status(checkouts: DataFrame, status: str) -> DataFrame:
    """Checkouts with one payment status."""
    return checkouts.where(F.col("payment_status") == status)


def _money_sums() -> list[Column]:
    return [
        F.sum("total_cost").alias("revenue"),
        F.sum("profit").alias("profit"),
        F.sum("quantity").alias("quantity"),
    ]


def count_by(checkouts: DataFrame, dimension: str, status: str, window: str = WINDOW) -> DataFrame:
    """Checkouts of one status counted per dimension value and window."""
    return (
        with_status(checkouts, status)
        .groupBy(dimension, F.window("purchase_time", window))
        .agg(F.count("*").alias("count"))
        .select(dimension, "count", F.col("window.end").alias("time"))
    )


def revenue_by_window(checkouts: DataFrame, window: str = WINDOW) -> DataFrame:
    """Revenue, profit and quantity of successful checkouts per window."""
    return (
        with_status(checkouts, SUCCESS)
        .groupBy(F.window("purchase_time", window))
        .agg(*_money_sums())
        .select("revenue", "profit", "quantity", F.col("window.end").alias("time"))
    )


def rollup(checkouts: DataFrame, table: str, window: str = WINDOW) -> DataFrame:
    """One of the five roll-up tables, computed straight from checkouts."""
    if table == "revenue":
        return revenue_by_window(checkouts, window)
    status, dimension = COUNT_TABLES[table]
    return count_by(checkouts, dimension, status, window)


def rollup_cube(checkouts: DataFrame, window: str = WINDOW) -> DataFrame:
    """Every roll-up in one pass: counts and sums per window and dimension tuple.

    One scan, one map-side combined shuffle and, on a stream, one state store
    serve all five tables. All tuples of a window close in the same
    micro-batch, so :func:`rollup_from_cube` on that batch is already final.
    """
    return (
        checkouts.groupBy(*CUBE_DIMENSIONS, F.window("purchase_time", window))
        .agg(F.count("*").alias("count"), *_money_sums())
        .select(
            *CUBE_DIMENSIONS,
            "count",
            "revenue",
            "profit",
            "quantity",
            F.col("window.end").alias("time"),
        )
    )


def rollup_from_cube(cube: DataFrame, table: str) -> DataFrame:
    """One of the five roll-up tables, out of :func:`rollup_cube`."""
    if table == "revenue":
        return (
            with_status(cube, SUCCESS)
            .groupBy("time")
            .agg(
                F.sum("revenue").alias("revenue"),
                F.sum("profit").alias("profit"),
                F.sum("quantity").alias("quantity"),
            )
            .select("revenue", "profit", "quantity", "time")
        )
    status, dimension = COUNT_TABLES[table]
    return (
        with_status(cube, status)
        .groupBy(dimension, "time")
        .agg(F.sum("count").alias("count"))
        .select(dimension, "count", "time")
    )
