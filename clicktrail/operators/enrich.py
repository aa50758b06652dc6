"""Purchases joined to user and product dimensions, with recomputed money."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.operators.skew import Salts, copied, salted, tasks_of
from clicktrail.schemas import MONEY, ORDER_TOTAL, RATE, UNITS

#: Payload columns that only feed the recomputation.
INPUTS_ONLY = ("price", "discount", "shipping_cost", "commission_rate")


def join_dimension(facts: DataFrame, dimension: DataFrame, key: str, salts: Salts = 1) -> DataFrame:
    """Inner join of facts to a dimension that is unique on ``key``.

    In batch Spark itself broadcasts the dimension when its size is under
    ``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides shuffle and
    skew handling splits the facts of a hot key. A micro-batch has neither
    run-time sizes nor skew handling: a batch without new input even looks
    empty to the planner while its state is releasing rows. So a stream states
    the side (:func:`of_micro_batches`), and where it is merge-joined ``salts``
    spreads the facts of hot keys (or of all) over several tasks and repeats
    their dimension rows once per task; other rows are not copied.
    """
    if facts.isStreaming and _is_small(dimension):
        return facts.join(F.broadcast(dimension), key)
    keys = [key]
    tasks = tasks_of(salts, key)
    if tasks is not None:
        keys.append("_salt")
        facts, dimension = salted(facts, tasks, "purchase_id"), copied(dimension, tasks)
    if facts.isStreaming:
        dimension = dimension.hint("merge")
    return facts.join(dimension, keys).drop("_salt")


def of_micro_batches(dimension: DataFrame) -> DataFrame:
    """A dimension that every micro-batch joins anew, with the kind of join it is to have: by broadcast or by merging."""
    return F.broadcast(dimension) if _is_small(dimension) else dimension.hint("merge")


def _is_small(table: DataFrame) -> bool:
    """Whether a table's rows, and not only its compressed files, are under the broadcast threshold.

    A broadcast passes through the driver as rows, ten and more times the size of
    their files, and a stream repeats it in every micro-batch. So the planner's
    estimate, which is that of the files, only saves larger tables the counting.
    """
    threshold = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    estimate = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= threshold and row_bytes(table) <= threshold


def row_bytes(table: DataFrame) -> int:
    """Bytes of a table's rows in memory: eight for each column, and its value as text."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) for name in table.columns]
    widths = [F.lit(8) + text for text in texts]
    return table.agg(F.sum(reduce(add, widths, F.lit(0)))).first()[0] or 0


def with_order_total(purchases: DataFrame) -> DataFrame:
    """Replace ``total_cost`` by price x quantity x (1 - discount) + shipping.

    A value too large for its type makes the total NULL; it must not end a stream.
    """
    goods = (
        F.col("price").try_cast(MONEY)
        * F.col("quantity").try_cast(UNITS)
        * (F.lit(1).cast("decimal(1,0)") - F.col("discount").try_cast(RATE))
    )
    total = goods + F.col("shipping_cost").try_cast(MONEY)
    return purchases.withColumn("total_cost", total.try_cast(ORDER_TOTAL))


def with_profit(purchases: DataFrame) -> DataFrame:
    """Add ``profit``: commission on the recomputed total without shipping."""
    goods = F.col("total_cost") - F.col("shipping_cost").try_cast(MONEY)
    return purchases.withColumn("profit", goods * F.col("commission_rate").try_cast(RATE))


def enrich_purchases(
    purchases: DataFrame, users: DataFrame, products: DataFrame, salts: Salts = 1
) -> DataFrame:
    """Purchases with known user and product, recomputed total and profit.

    Products join first: they are the smaller dimension, so the wide user
    columns travel through at most one shuffle.
    """
    joined = join_dimension(purchases, products, "product_id", salts)
    joined = join_dimension(joined, users, "user_id", salts)
    return with_profit(with_order_total(joined)).drop(*INPUTS_ONLY)
