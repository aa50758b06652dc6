"""Serving reports over the roll-up tables.

``as_of`` stands for "now": a literal, a column or a one-row scalar such as
``latest(table)``. The horizon is inclusive at its old end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.functions.temporal import AsOf, instant, interval

HORIZON = "1 hour"
TOP_CATEGORIES = 10


def latest(table: DataFrame, time: str = "time") -> Column:
    """The newest instant of a table as a scalar subquery."""
    return table.agg(F.max(time)).scalar()


def since(table: DataFrame, as_of: AsOf, horizon: str = HORIZON) -> DataFrame:
    """Rows no older than ``horizon`` before ``as_of``."""
    return table.where(F.col("time") >= instant(as_of) - interval(horizon))


def totals(table: DataFrame, dimension: str, as_of: AsOf, horizon: str = HORIZON) -> DataFrame:
    """Window counts summed per dimension value over the trailing horizon."""
    return since(table, as_of, horizon).groupBy(dimension).agg(F.sum("count").alias("count"))


def report_revenue(revenue: DataFrame, as_of: AsOf | None = None, horizon: str = HORIZON) -> DataFrame:
    """Revenue and profit series in time order, whole unless ``as_of`` is given."""
    rows = revenue if as_of is None else since(revenue, as_of, horizon)
    return rows.select("revenue", "profit", "time").orderBy("time")


def report_sources(source_count: DataFrame, as_of: AsOf, horizon: str = HORIZON) -> DataFrame:
    """Traffic sources by successful checkouts, most first."""
    return totals(source_count, "source", as_of, horizon).orderBy(F.desc("count"), "source")


def report_top_categories(
    category_count: DataFrame, as_of: AsOf, horizon: str = HORIZON, k: int = TOP_CATEGORIES
) -> DataFrame:
    """The ``k`` product categories with most successful checkouts."""
    ranked = totals(category_count, "category", as_of, horizon)
    return ranked.orderBy(F.desc("count"), "category").limit(k)


def report_gender(gender_count: DataFrame, as_of: AsOf, horizon: str = HORIZON) -> DataFrame:
    """Successful checkouts per customer gender and their share of the whole.

    The share's single-partition window sees one row per gender.
    """
    counts = totals(gender_count, "gender", as_of, horizon)
    share = F.col("count") / F.sum("count").over(Window.partitionBy())
    return counts.withColumn("share", share)


def report_failures(fail_count: DataFrame, as_of: AsOf, horizon: str = HORIZON) -> DataFrame:
    """Failure reasons by failed checkouts, most first."""
    return totals(fail_count, "description", as_of, horizon).orderBy(F.desc("count"), "description")
