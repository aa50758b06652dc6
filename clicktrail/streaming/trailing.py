"""Trailing first-click attribution of a stream.

A stream-stream join on the trailing lookback would emit every click and
purchase pair of a user before the earliest could be picked. Instead, events
*settle*: each is held in state under its own id, evenly spread, until the
watermark closes its minute, and redelivered copies collapse on the way. What
settles is appended to click and purchase tables, and the purchases of each
micro-batch are attributed by the batch operator against the settled clicks
of their lookback. All clicks up to a settled purchase have settled with it or
before it, so the result equals the batch result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from clicktrail.functions.codec import decode_clicks, decode_purchases
from clicktrail.functions.temporal import micros
from clicktrail.operators.enrich import of_micro_batches
from clicktrail.plans.checkouts import trailing_checkouts
from clicktrail.schemas import CHECKOUTS, CLICKS, PURCHASES
from clicktrail.session import stateful_stream_conf
from clicktrail.sinks.tables import query_id, write_batch
from clicktrail.sources.tables import read_days
from clicktrail.streaming.pipeline import BatchWriter, Timing, write_tables
from clicktrail.streaming.triggers import Trigger

CLICK, PURCHASE = "click", "purchase"

#: Every settled purchase is attributed once, so its rows need no comparing with stored ones.
TRAILING_CHECKOUTS = replace(CHECKOUTS, first_by=())


def settled_events(click_events: DataFrame, purchase_events: DataFrame, timing: Timing = Timing()) -> DataFrame:
    """Clicks and purchases, once each, when no earlier event can follow any more.

    Copies of one event share its id. An event without id is told from others
    by its content, and equal ones are counted and come out as often as they
    came in. Of events that share an id and a minute but differ, the smallest
    stays.
    """
    clicks = decode_clicks(click_events).select(
        F.lit(CLICK).alias("kind"),
        F.col("click_id").alias("id"),
        F.col("click_time").alias("at"),
        F.struct(*CLICKS.columns).alias(CLICK),
    )
    purchases = decode_purchases(purchase_events).select(
        F.lit(PURCHASE).alias("kind"),
        F.col("purchase_id").alias("id"),
        F.col("purchase_time").alias("at"),
        F.struct(*PURCHASES.columns).alias(PURCHASE),
    )
    content = F.when(F.col("id").isNull(), F.sha2(F.concat_ws("\n", F.to_json(CLICK), F.to_json(PURCHASE)), 256))
    return (
        clicks.unionByName(purchases, allowMissingColumns=True)
        .withColumn("content", content)
        .withWatermark("at", timing.lateness)
        .groupBy("kind", "id", "content", F.window("at", timing.window))
        .agg(F.min(CLICK).alias(CLICK), F.min(PURCHASE).alias(PURCHASE), F.count(F.lit(1)).alias("copies"))
        .withColumn("copies", F.when(F.col("id").isNull(), F.col("copies")).otherwise(1))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long"))))
        .drop("window", "content", "copies", "copy")
    )


#: A dimension: a table, or a function that finds the table to use now.
Dimension = DataFrame | Callable[[], DataFrame]


def current(dimension: Dimension) -> DataFrame:
    return dimension() if callable(dimension) and not isinstance(dimension, DataFrame) else dimension


def stated(dimension: Dimension) -> Dimension:
    """A dimension with its kind of join, found now for a table and at each look-up for a function."""
    if isinstance(dimension, DataFrame):
        return of_micro_batches(dimension)
    return lambda: of_micro_batches(current(dimension))


def days_before(day: dt.date, lookback: str) -> list[dt.date]:
    """A day and the days its lookback reaches into."""
    return [day - dt.timedelta(days=n) for n in range(-(-micros(lookback) // micros("1 day")) + 1)]


def within(time: str, begin: int, end: int) -> Column:
    """Whether a time lies between two instants in microseconds; they become literals, which Parquet readers can skip by."""
    return F.col(time).between(F.timestamp_micros(F.lit(begin)), F.timestamp_micros(F.lit(end)))


def settlement_writer(
    spark: SparkSession, users: Dimension, products: Dimension, root: str, lookback: str
) -> BatchWriter:
    """Stores what settled and attributes the batch's purchases.

    The attribution reads the tables back in the session ``spark``, so it is
    planned as any batch query, with adaptive execution. Only the folders of
    the days that the batch's purchases look back on are listed and read.
    Dimensions given as functions are looked up in every micro-batch. How a
    dimension is joined is stated as in streamed joins, since every micro-batch
    joins it anew.
    """
    users, products = stated(users), stated(products)
    paths = {name: f"{root}/{name}" for name in ("clicks", "purchases", "checkouts")}

    def write(settled: DataFrame, batch_id: int) -> None:
        query = query_id(settled)
        settled.persist()
        try:
            for kind, path, contract in (
                (CLICK, paths["clicks"], CLICKS),
                (PURCHASE, paths["purchases"], PURCHASES),
            ):
                rows = settled.where(F.col("kind") == kind).select(f"{kind}.*")
                write_batch(rows, path, contract, batch_id, query=query)
            time = F.col("purchase.purchase_time")
            bought = settled.where(time.isNotNull()).groupBy(F.to_date(time).alias("day"))
            micro = F.unix_micros(time)
            spans = bought.agg(F.min(micro).alias("begin"), F.max(micro).alias("end")).collect()
            days = [row.day for row in spans]
        finally:
            settled.unpersist()
        stored = read_days(spark, paths["purchases"], PURCHASES, days)
        if stored is None:
            return
        own = stored.where((F.col("query") == query) & (F.col("batch_id") == batch_id))
        reached = sorted({before for day in days for before in days_before(day, lookback)})
        clicks = read_days(spark, paths["clicks"], CLICKS, reached)
        if clicks is None:
            return
        length = micros(lookback)
        in_reach = reduce(or_, [within("click_time", row.begin - length, row.end) for row in spans])
        # merged with what they are attributed to, not sent through the driver in every micro-batch
        purchases = own.select(*PURCHASES.columns).hint("merge")
        checkouts = trailing_checkouts(
            clicks.where(in_reach).select(*CLICKS.columns), purchases, current(users), current(products), lookback
        )
        write_batch(checkouts, paths["checkouts"], TRAILING_CHECKOUTS, batch_id, query=query)

    return write


def start_trailing_checkouts(
    click_events: DataFrame,
    purchase_events: DataFrame,
    users: Dimension,
    products: Dimension,
    root: str,
    checkpoint: str,
    timing: Timing = Timing(),
    trigger: Trigger = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep click, purchase and trailing-checkout tables under ``root`` up to date."""
    with stateful_stream_conf(click_events.sparkSession, state_partitions):
        return write_tables(
            settled_events(click_events, purchase_events, timing),
            settlement_writer(click_events.sparkSession, users, products, root, timing.lookback),
            checkpoint,
            trigger,
            "trailing checkouts",
        )
