"""The streaming pipeline run over the generated tables.

The tables are encoded once per session and data set into topic directories
under the shared work folder, in the order of time and as several files, as
producers would have sent them. Streams read one file of each topic in a
micro-batch. When they have read all, a flush message of a user nobody knows,
far in the future, is published and the queries are started again on their
checkpoints; it moves the watermarks past the last real window and is dropped
by the enrichment.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from clicktrail.functions.codec import check_clicks, decode_clicks, decode_purchases, decode_rows, encode_rows
from clicktrail.plans import testdata_views as views
from clicktrail.plans.stored import once
from clicktrail.schemas import CHECKOUTS, CLICKS, PRODUCTS, ROLLUPS, USERS
from clicktrail.session import work_dir
from clicktrail.sinks.tables import load_dimension, parquet_store, read_dimension
from clicktrail.sinks.topics import append_topic
from clicktrail.sources.tables import file_system, fingerprint, read_rows
from clicktrail.sources.topics import load_topics, read_topics, topic_dir
from clicktrail.streaming.pipeline import (
    HotIn,
    Timing,
    checkout_stream,
    checkouts_of_topic,
    provisional_rollup,
    settled_min_clicks,
    start_checkout_table,
    start_checkouts,
    start_final_clicks,
    start_min_clicks,
    start_provisional_rollups,
    start_rollups,
)
from clicktrail.streaming.side_outputs import start_side_outputs
from clicktrail.streaming.state import state_of, state_operators
from clicktrail.streaming.trailing import start_trailing_checkouts
from clicktrail.streaming.triggers import Trigger

FLUSH_USER = "flush"
FLUSH_TIME = "2100-01-01 00:00:00"
#: Topics that get a flush message.
FLUSHED = ("clicks", "purchases", "checkouts")
#: A replay has at least so many micro-batches.
MICRO_BATCHES = 5
#: Bytes of the events' table for one file of a topic, and for one shard of state (of which there are some at least).
FILE_BYTES, SHARD_BYTES, LEAST_SHARDS = 4 << 20, 8 << 20, 4


def event_bytes(spark: SparkSession, sf_dir: str) -> int:
    return sum(length for _, length, _ in fingerprint(spark, f"{sf_dir}/events.parquet"))


def topic_files(spark: SparkSession, sf_dir: str) -> int:
    """Files of a staged topic: by its size, equally many for each micro-batch and at least one."""
    return MICRO_BATCHES * max(1, -(-event_bytes(spark, sf_dir) // (MICRO_BATCHES * FILE_BYTES)))


def files_per_batch(spark: SparkSession, sf_dir: str) -> int:
    return topic_files(spark, sf_dir) // MICRO_BATCHES


def state_shards(spark: SparkSession, sf_dir: str) -> int:
    """State shards of a replay: by the size of its input, up to the session's shuffle width."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(LEAST_SHARDS, min(width, -(-event_bytes(spark, sf_dir) // SHARD_BYTES)))


def flush_messages(rows: DataFrame, encode, time: str) -> DataFrame:
    """One message with a time and placeholders, in the topic's own encoding.

    No field is NULL: Spark drops rows with NULL join keys before it looks at
    their event time.
    """
    values = {name: F.lit(FLUSH_TIME if name == time else FLUSH_USER) for name in rows.columns}
    return encode(rows.sparkSession.range(1).select([v.alias(name) for name, v in values.items()]))


def staged_topics(spark: SparkSession, sf_dir: str) -> str:
    """Root of the click and purchase topics of a data set."""

    def stage() -> str:
        root = work_dir(spark, "topics")
        clicks, purchases = views.clicks(spark, sf_dir), views.purchases(spark, sf_dir)
        files = topic_files(spark, sf_dir)
        stage_in_order(clicks, views.click_messages, "click_time", root, "clicks", files)
        stage_in_order(purchases, views.purchase_messages, "purchase_time", root, "purchases", files)
        return root

    return once(spark, sf_dir, "topics", make=stage)


def stage_in_order(rows: DataFrame, encode, time: str, root: str, topic: str, files: int) -> None:
    """A topic as files that follow one another in time; readers take files by their modification time."""
    spark = rows.sparkSession
    append_topic(encode(rows.repartitionByRange(files, time).sortWithinPartitions(time)), root, topic)
    location, fs = file_system(spark, topic_dir(root, topic))
    found = [s.getPath() for s in fs.listStatus(location) if s.getPath().getName().startswith("part-")]
    found.sort(key=lambda path: path.getName())
    newest = fs.getFileStatus(location).getModificationTime()
    for n, path in enumerate(found):
        fs.setTimes(path, newest - 1000 * (len(found) - n), -1)


def stage_flush(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The flush message of every topic."""
    clicks, purchases = views.clicks(spark, sf_dir), views.purchases(spark, sf_dir)
    append_topic(flush_messages(clicks, views.click_messages, "click_time"), root, "clicks")
    append_topic(flush_messages(purchases, views.purchase_messages, "purchase_time"), root, "purchases")
    append_topic(flush_messages(_checkout_times(spark), encode_rows, "purchase_time"), root, "checkouts")


def _checkout_times(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "purchase_id string, user_id string, purchase_time string")


def run_and_flush(spark: SparkSession, sf_dir: str, flush: str, start: Callable[[], StreamingQuery]) -> None:
    """Run a query over what is there, publish the flush messages under ``flush``, and run it again from its checkpoint."""
    for topic in FLUSHED:
        location, fs = file_system(spark, topic_dir(flush, topic))
        fs.mkdirs(location)
    start().awaitTermination()
    stage_flush(spark, sf_dir, flush)
    start().awaitTermination()


def with_flush(spark: SparkSession, root: str, topic: str, flush: str, files: int) -> DataFrame:
    """A topic, so many files a micro-batch, and its flush message once there is one."""
    return read_topics(spark, root, topic, files_per_batch=files).unionByName(read_topics(spark, flush, topic))


def event_streams(spark: SparkSession, sf_dir: str, flush: str) -> tuple[DataFrame, DataFrame]:
    """Click and purchase messages."""
    root, files = staged_topics(spark, sf_dir), files_per_batch(spark, sf_dir)
    return with_flush(spark, root, "clicks", flush, files), with_flush(spark, root, "purchases", flush, files)


def faulty_messages(rows: DataFrame) -> DataFrame:
    """Click messages, three in eleven of which have a fault: cut off, without a time that can be read, without an id."""
    kind, value = F.col("click_id") % 11, F.col("value")
    messages = rows.select("click_id", "click_time", views.click_text().alias("value"))
    faulty = (
        F.when(kind == 0, F.substring(value, 1, 20))
        .when(kind == 1, F.regexp_replace(value, '"Click_time":"[^"]*"', '"Click_time":"soon"'))
        .when(kind == 2, F.regexp_replace(value, '"Click_ID":"[^"]*",', ""))
        .otherwise(value)
    )
    return messages.select("click_id", "click_time", F.lit("clicks").alias("topic"), faulty.alias("value"))


def delivery(clicks: DataFrame) -> Column:
    """In which of five deliveries a click comes: by its time, but one in ten two deliveries later."""
    micros = F.unix_micros(F.col("click_time").cast("timestamp"))
    first, last = clicks.agg(F.min(micros), F.max(micros)).first()
    place = F.floor((micros - F.lit(first)) * MICRO_BATCHES / F.lit((last or 0) - (first or 0) + 1)).cast("int")
    delayed = F.when(F.col("click_id") % 10 == 3, place + 2).otherwise(place)
    return F.least(delayed, F.lit(MICRO_BATCHES - 1))


def side_outputs(spark: SparkSession, sf_dir: str, lateness: str, trigger: Trigger) -> str:
    """A disordered and faulty click topic, delivered in five parts, split into clicks, late clicks and rejects."""

    def run() -> str:
        root = work_dir(spark, "side-outputs")
        clicks = views.clicks(spark, sf_dir)
        messages = faulty_messages(clicks).withColumn("part", delivery(clicks))
        for part in range(MICRO_BATCHES):
            append_topic(messages.where(F.col("part") == part), root, "clicks")
            checked = check_clicks(read_topics(spark, root, "clicks"))
            start_side_outputs(checked, f"{root}/tables", "clicks", CLICKS, f"{root}/checkpoint", lateness, trigger).awaitTermination()
        return f"{root}/tables"

    return once(spark, sf_dir, "side-outputs", lateness, make=run)


def loaded_dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Users and products as stored tables, whose size the planner knows."""

    def load() -> str:
        root = work_dir(spark, "dimensions")
        load_dimension(views.users(spark, sf_dir), f"{root}/users", USERS)
        load_dimension(views.products(spark, sf_dir), f"{root}/products", PRODUCTS)
        return root

    root = once(spark, sf_dir, "dimensions", make=load)
    return read_dimension(spark, f"{root}/users", USERS), read_dimension(spark, f"{root}/products", PRODUCTS)


def min_clicks_topic(spark: SparkSession, sf_dir: str, lookback: str, trigger: Trigger) -> DataFrame:
    """Click topic to minima topic in update mode, settled."""

    def run() -> str:
        root = work_dir(spark, "min-clicks-stream")
        clicks = read_topics(spark, staged_topics(spark, sf_dir), "clicks", files_per_batch(spark, sf_dir))
        timing, shards = Timing(lookback=lookback), state_shards(spark, sf_dir)
        start_min_clicks(clicks, root, f"{root}/checkpoint", timing, trigger, shards).awaitTermination()
        return root

    root = once(spark, sf_dir, "min-clicks", lookback, make=run)
    return settled_min_clicks(load_topics(spark, root, "min_clicks"), lookback)


def final_clicks_root(spark: SparkSession, sf_dir: str, lookback: str, trigger: Trigger) -> str:
    """Click topic to final-clicks topic; the query's checkpoint lies beside it."""

    def run() -> str:
        root, flush = work_dir(spark, "final-clicks-stream"), work_dir(spark, "flush")

        def start() -> StreamingQuery:
            clicks, _ = event_streams(spark, sf_dir, flush)
            timing = Timing(lookback=lookback)
            return start_final_clicks(clicks, root, f"{root}/checkpoint", timing, trigger, state_shards(spark, sf_dir))

        run_and_flush(spark, sf_dir, flush, start)
        return root

    return once(spark, sf_dir, "final-clicks", lookback, make=run)


def final_clicks_topic(spark: SparkSession, sf_dir: str, lookback: str, trigger: Trigger) -> DataFrame:
    """Click topic to final-clicks topic, decoded."""
    root = final_clicks_root(spark, sf_dir, lookback, trigger)
    return decode_clicks(load_topics(spark, root, "final_clicks"), "final_clicks", CLICKS.columns)


def checkouts_root(spark: SparkSession, sf_dir: str, lookback: str, trigger: Trigger, hot: bool = False) -> str:
    """Topics to checkouts topic; with ``hot``, hot users and products of the staged purchases are salted."""

    def run() -> str:
        root, flush = work_dir(spark, "checkouts-stream"), work_dir(spark, "flush")

        def start() -> StreamingQuery:
            return start_checkouts(
                *event_streams(spark, sf_dir, flush),
                *loaded_dimensions(spark, sf_dir),
                topics=root,
                checkpoint=f"{root}/checkpoints/attribution",
                timing=Timing(lookback=lookback),
                trigger=trigger,
                state_partitions=state_shards(spark, sf_dir),
                hot_in=HotIn(decode_purchases(load_topics(spark, staged_topics(spark, sf_dir), "purchases"))) if hot else None,
            )

        run_and_flush(spark, sf_dir, flush, start)
        return root

    return once(spark, sf_dir, "checkouts-of-hot-keys" if hot else "checkouts", lookback, make=run)


def checkouts_of_hot_keys(spark: SparkSession, sf_dir: str, lookback: str, trigger: Trigger) -> DataFrame:
    """Topics to checkouts topic with salted hot keys, decoded."""
    root = checkouts_root(spark, sf_dir, lookback, trigger, hot=True)
    return decode_rows(load_topics(spark, root, "checkouts"), "checkouts", CHECKOUTS.schema)


def checkouts_table(spark: SparkSession, sf_dir: str, lookback: str, trigger: Trigger) -> DataFrame:
    """Topics to checkouts topic to checkouts table, by two streaming queries."""
    root = checkouts_root(spark, sf_dir, lookback, trigger)

    def run() -> str:
        out, flush = work_dir(spark, "checkouts-table"), work_dir(spark, "flush")

        def start() -> StreamingQuery:
            return start_checkout_table(
                with_flush(spark, root, "checkouts", flush, state_shards(spark, sf_dir)),
                parquet_store(out),
                f"{out}/checkpoint",
                trigger,
                lookback=lookback,
                state_partitions=state_shards(spark, sf_dir),
            )

        run_and_flush(spark, sf_dir, flush, start)
        return out

    out = once(spark, sf_dir, "checkouts-table", lookback, make=run)
    return read_rows(spark, f"{out}/checkouts", CHECKOUTS)


def topic_rollup_tables(spark: SparkSession, sf_dir: str, lookback: str, trigger: Trigger) -> dict[str, DataFrame]:
    """Topics to checkouts topic to the five roll-up tables, by two streaming queries."""
    root = checkouts_root(spark, sf_dir, lookback, trigger)

    def run() -> str:
        out, flush = work_dir(spark, "topic-rollups"), work_dir(spark, "flush")

        def start() -> StreamingQuery:
            # the topic has one file for each shard of the join and micro-batch
            messages = with_flush(spark, root, "checkouts", flush, state_shards(spark, sf_dir))
            return start_rollups(
                checkouts_of_topic(messages, lookback=lookback),
                parquet_store(out, gather_days=True),
                f"{out}/checkpoint",
                trigger=trigger,
                state_partitions=state_shards(spark, sf_dir),
            )

        run_and_flush(spark, sf_dir, flush, start)
        return out

    out = once(spark, sf_dir, "topic-rollups", lookback, make=run)
    return {table: read_rows(spark, f"{out}/{table}", contract) for table, contract in ROLLUPS.items()}


def provisional_tables(spark: SparkSession, sf_dir: str, lookback: str, trigger: Trigger) -> dict[str, DataFrame]:
    """Topics to checkouts topic to a changelog of the roll-ups, the latest versions of which are read; nothing is flushed."""
    root = checkouts_root(spark, sf_dir, lookback, trigger)

    def run() -> str:
        out = work_dir(spark, "provisional-rollups")
        topic = read_topics(spark, root, "checkouts", state_shards(spark, sf_dir))
        start_provisional_rollups(
            checkouts_of_topic(topic, lookback=lookback),
            f"{out}/cube",
            f"{out}/checkpoint",
            trigger=trigger,
            state_partitions=state_shards(spark, sf_dir),
        ).awaitTermination()
        return out

    out = once(spark, sf_dir, "provisional", lookback, make=run)
    return {table: provisional_rollup(spark, f"{out}/cube", table) for table in ROLLUPS}


def open_windows(spark: SparkSession, sf_dir: str, lookback: str, trigger: Trigger) -> DataFrame:
    """What the first-click query still holds in state after the flush: (user_id, window_start) of windows not closed yet."""
    checkpoint = f"{final_clicks_root(spark, sf_dir, lookback, trigger)}/checkpoint"
    operators = [row.operatorId for row in state_operators(spark, checkpoint).collect()]
    return reduce(DataFrame.unionByName, [state_of(spark, checkpoint, n) for n in operators]).select(
        "key.user_id", F.col("key.window.start").alias("window_start")
    )


def rollup_tables(spark: SparkSession, sf_dir: str, lookback: str, trigger: Trigger) -> dict[str, DataFrame]:
    """Topics to the five roll-up tables, attribution and roll-up in one streaming query."""

    def run() -> str:
        root, flush = work_dir(spark, "rollup-stream"), work_dir(spark, "flush")

        def start() -> StreamingQuery:
            checkouts = checkout_stream(
                *event_streams(spark, sf_dir, flush), *loaded_dimensions(spark, sf_dir), timing=Timing(lookback=lookback)
            )
            store = parquet_store(root, gather_days=True)
            return start_rollups(
                checkouts, store, f"{root}/checkpoint", trigger=trigger, state_partitions=state_shards(spark, sf_dir)
            )

        run_and_flush(spark, sf_dir, flush, start)
        return root

    root = once(spark, sf_dir, "rollups", lookback, make=run)
    return {table: read_rows(spark, f"{root}/{table}", contract) for table, contract in ROLLUPS.items()}


def trailing_table(spark: SparkSession, sf_dir: str, lookback: str, trigger: Trigger) -> DataFrame:
    """Topics to settled tables to trailing checkouts, in one streaming query."""

    def run() -> str:
        root, flush = work_dir(spark, "trailing-stream"), work_dir(spark, "flush")

        def start() -> StreamingQuery:
            return start_trailing_checkouts(
                *event_streams(spark, sf_dir, flush),
                *loaded_dimensions(spark, sf_dir),
                root=root,
                checkpoint=f"{root}/checkpoint",
                timing=Timing(lookback=lookback),
                trigger=trigger,
                state_partitions=state_shards(spark, sf_dir),
            )

        run_and_flush(spark, sf_dir, flush, start)
        return root

    root = once(spark, sf_dir, "trailing", lookback, make=run)
    return read_rows(spark, f"{root}/checkouts", CHECKOUTS)
