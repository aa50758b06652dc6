from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from clicktrail.schemas import CLICKS, PRODUCTS, PURCHASES, USERS

NOON = dt.datetime(2024, 1, 1, 12, 0)


def at(text: str) -> dt.datetime:
    """A time on 2024-01-01, from ``HH:MM[:SS[.ffffff]]``."""
    return dt.datetime.fromisoformat(f"2024-01-01T{text}")


def clicks(spark: SparkSession, *rows) -> DataFrame:
    """Clicks from (click_id, user_id, click_time[, source]) tuples."""
    full = [(r[0], r[1], r[2], "Homepage", r[3] if len(r) > 3 else "Google", "10.0.0.1") for r in rows]
    return spark.createDataFrame(full, CLICKS.schema)


def purchases(spark: SparkSession, *rows, **changes) -> DataFrame:
    """Purchases from (purchase_id, user_id, purchase_time) tuples."""
    from decimal import Decimal as D

    base = dict(
        product_id="p1",
        shipping_cost=D("5"),
        discount=D("0.1"),
        total_cost=D("1"),
        payment_method="Visa",
        quantity=D("2"),
        payment_status="success",
        description="none",
    )
    base |= changes
    full = [
        tuple({"purchase_id": r[0], "user_id": r[1], "purchase_time": r[2], **base}[c] for c in PURCHASES.columns)
        for r in rows
    ]
    return spark.createDataFrame(full, PURCHASES.schema)


def users(spark: SparkSession, *ids: str) -> DataFrame:
    day = dt.date(2000, 1, 1)
    rows = [(i, f"name {i}", f"{i}@example.com", "F", day, "here", "000", day) for i in ids]
    return spark.createDataFrame(rows, USERS.schema)


def products(spark: SparkSession, *ids: str) -> DataFrame:
    from decimal import Decimal as D

    return spark.createDataFrame(
        [(i, f"thing {i}", "TOYS", "Acme", D("10.00"), D("0.05")) for i in ids], PRODUCTS.schema
    )


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    selected = df.select(*columns) if columns else df.select(*sorted(df.columns))
    return sorted((tuple(r) for r in selected.collect()), key=repr)
