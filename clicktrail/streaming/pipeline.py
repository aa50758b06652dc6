"""The streaming product: topics in, checkouts and roll-up tables out.

The batch operators run unchanged; this module adds watermarks, sinks and the
wiring between topics.

Checkouts leave the attribution join out of time order: when a click window
closes it releases purchases up to one lookback older or younger than the
window end. Roll-ups chained to the join in one query know that from the
propagated watermark. Roll-ups that read the checkouts topic must allow for
it, hence their longer delay.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from clicktrail.functions.codec import decode_clicks, decode_purchases, decode_rows
from clicktrail.functions.temporal import micros
from clicktrail.operators.attribution import LOOKBACK, final_clicks, min_click
from clicktrail.operators.contracts import latest_versions, settled_first_rows
from clicktrail.operators.rollups import WINDOW, rollup_cube, rollup_from_cube
from clicktrail.operators.skew import ONE_IN, Salts, as_salts, salts_for
from clicktrail.plans.checkouts import checkouts_of_first_clicks, windowed_checkouts
from clicktrail.schemas import CHECKOUT_MESSAGE, CHECKOUTS, CLICKS, CUBE, MIN_CLICK_MESSAGE, ROLLUPS, TableContract
from clicktrail.session import stateful_stream_conf
from clicktrail.sinks.tables import Store, query_id, write_batch, writers
from clicktrail.sinks.topics import TopicSink, topic_sink
from clicktrail.sources.tables import exists, read_table
from clicktrail.streaming.triggers import ROLLUP_TRIGGER, Trigger, with_trigger

BatchWriter = Callable[[DataFrame, int], None]

#: Tasks that share one key's purchases in a streamed join, where nothing splits
#: a hot key at run time. The join key, user and lookback bucket, is fine
#: already, so only hot users need more: see :class:`HotIn`.
SALTS = 1


@dataclass(frozen=True)
class Timing:
    """Lookback, lateness and roll-up window of a pipeline."""

    lookback: str = LOOKBACK
    lateness: str = "10 minutes"
    window: str = WINDOW


@dataclass(frozen=True)
class HotIn:
    """Purchases at hand (of the day before, say) in which hot users and products are looked up.

    A value is hot if at least one row in ``one_in`` has it.
    """

    purchases: DataFrame
    one_in: int = ONE_IN


def remembered_salts(hot_in: HotIn, checkpoint: str) -> Salts:
    """Salts of hot users and products, found when a checkpoint is first used and the same ever after.

    State is dealt out by salt, so other salts would part purchases from the
    clicks that are waiting for them. They are stored beside the checkpoint
    before the query first starts; a write that was cut off is done again. A
    checkpoint that was started without them is refused.
    """
    spark, path = hot_in.purchases.sparkSession, f"{checkpoint.rstrip('/')}-salts"
    if not exists(spark, f"{path}/_SUCCESS"):
        if exists(spark, f"{checkpoint}/offsets"):
            raise ValueError(f"{checkpoint} was started without salts of hot keys")
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = salts_for(hot_in.purchases, ("user_id", "product_id"), tasks, hot_in.one_in)
        found.coalesce(1).write.mode("overwrite").parquet(path)
    return as_salts(spark.read.schema("key STRING, value STRING, tasks INT").parquet(path))


def checkout_stream(
    click_events: DataFrame,
    purchase_events: DataFrame,
    users: DataFrame,
    products: DataFrame,
    timing: Timing = Timing(),
    salts: Salts = SALTS,
    redelivery: bool = False,
) -> DataFrame:
    """Attributed checkouts out of streams of click and purchase messages.

    Each topic has its own scan; a shared subscription may be passed twice, and
    is then read twice. ``redelivery`` drops events that a source sends again
    within the lateness.
    """
    clicks = decode_clicks(click_events).withWatermark("click_time", timing.lateness)
    purchases = decode_purchases(purchase_events).withWatermark("purchase_time", timing.lateness)
    if redelivery:
        clicks = clicks.dropDuplicatesWithinWatermark(["click_id"])
        purchases = purchases.dropDuplicatesWithinWatermark(["purchase_id"])
    return windowed_checkouts(clicks, purchases, users, products, timing.lookback, salts)


def checkout_stream_of_final_clicks(
    final_click_events: DataFrame,
    purchase_events: DataFrame,
    users: DataFrame,
    products: DataFrame,
    timing: Timing = Timing(),
    salts: Salts = SALTS,
) -> DataFrame:
    """Attributed checkouts when first clicks come from their own topic.

    That topic is out of order by at most one window, the lookback.
    """
    clicks = decode_clicks(final_click_events, "final_clicks", CLICKS.columns)
    clicks = clicks.withWatermark("click_time", timing.lookback)
    purchases = decode_purchases(purchase_events).withWatermark("purchase_time", timing.lateness)
    return checkouts_of_first_clicks(clicks, purchases, users, products, timing.lookback, salts)


def checkouts_of_topic(
    events: DataFrame, topic: str = "checkouts", lookback: str = LOOKBACK, lateness: str | None = None
) -> DataFrame:
    """Checkouts read back from their topic, twice the lookback late unless ``lateness`` says otherwise.

    When a click window closes, its checkouts lie within one lookback either
    side of the window end, so two lookbacks cover every pair of batches.
    """
    late = lateness or f"{2 * micros(lookback)} microseconds"
    return decode_rows(events, topic, CHECKOUT_MESSAGE).withWatermark("purchase_time", late)


def write_tables(
    rows: DataFrame, write: BatchWriter, checkpoint: str, trigger: Trigger, name: str, mode: str = "append"
) -> StreamingQuery:
    """Run ``write`` on every micro-batch of a stream."""
    writer = (
        rows.writeStream.foreachBatch(write)
        .outputMode(mode)
        .queryName(f"{name} {checkpoint}")
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer, trigger).start()


def table_writer(store: Store, table: str, contract: TableContract) -> BatchWriter:
    """Writes each micro-batch to one table."""
    return lambda batch, batch_id: store(batch, table, contract, batch_id, query_id(batch))


def rollup_writer(store: Store) -> BatchWriter:
    """Writes each micro-batch of the roll-up cube to the five roll-up tables.

    A window's rows all arrive in the batch that closes it, so the sums over a
    batch are final. The batch is small (windows x dimension values) and read
    five times, hence cached for the length of the call.
    """

    def write(cube: DataFrame, batch_id: int) -> None:
        cube.persist()
        try:
            for table, contract in ROLLUPS.items():
                store(rollup_from_cube(cube, table), table, contract, batch_id, query_id(cube))
        finally:
            cube.unpersist()

    return write


def start_min_clicks(
    click_events: DataFrame,
    topics: TopicSink | str,
    checkpoint: str,
    timing: Timing = Timing(),
    trigger: Trigger = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Publish the earliest click time of each user and window whenever it changes (update mode)."""
    with stateful_stream_conf(click_events.sparkSession, state_partitions):
        clicks = decode_clicks(click_events).withWatermark("click_time", timing.lateness)
        minima = min_click(clicks, timing.lookback)
        return topic_sink(topics)(minima, "min_clicks", checkpoint, trigger, "update")


def settled_min_clicks(messages: DataFrame, window: str = LOOKBACK) -> DataFrame:
    """The last value of every minimum published so far; values only fall, so that is the smallest."""
    published = decode_rows(messages, "min_clicks", MIN_CLICK_MESSAGE)
    return min_click(published.select(F.col("min_user_id").alias("user_id"), F.col("min_click_time").alias("click_time")), window)


def start_final_clicks(
    click_events: DataFrame,
    topics: TopicSink | str,
    checkpoint: str,
    timing: Timing = Timing(),
    trigger: Trigger = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Publish the first click of each user and window on its own topic."""
    with stateful_stream_conf(click_events.sparkSession, state_partitions):
        clicks = decode_clicks(click_events).withWatermark("click_time", timing.lateness)
        return topic_sink(topics)(final_clicks(clicks, timing.lookback), "final_clicks", checkpoint, trigger, "append")


def start_checkouts(
    click_events: DataFrame,
    purchase_events: DataFrame,
    users: DataFrame,
    products: DataFrame,
    topics: TopicSink | str,
    checkpoint: str,
    timing: Timing = Timing(),
    trigger: Trigger = None,
    salts: Salts = SALTS,
    redelivery: bool = False,
    state_partitions: int | None = None,
    hot_in: HotIn | None = None,
) -> StreamingQuery:
    """Attribute purchases to clicks and publish the checkouts topic.

    The table and the roll-ups read that topic, so the join and its state
    exist once. With ``hot_in`` its hot users and products are salted, instead
    of all by ``salts``.
    """
    with stateful_stream_conf(click_events.sparkSession, state_partitions):
        if hot_in is not None:
            salts = remembered_salts(hot_in, checkpoint)
        checkouts = checkout_stream(
            click_events, purchase_events, users, products, timing, salts, redelivery
        )
        return topic_sink(topics)(checkouts, "checkouts", checkpoint, trigger, "append")


#: Checkouts of which a query sends each purchase once.
SETTLED_CHECKOUTS = replace(CHECKOUTS, settled=True)


def start_checkout_table(
    events: DataFrame,
    store: Store,
    checkpoint: str,
    trigger: Trigger = None,
    lookback: str = LOOKBACK,
    lateness: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep the table ``checkouts`` of a store up to date with the checkouts topic.

    The first click of each purchase is found in keyed state, one row a
    purchase, and stored when the watermark (see :func:`checkouts_of_topic`)
    passes the purchase: no micro-batch reads what this query has stored
    before. Only if other queries have written to the table, as before a move to
    a new checkpoint, are their rows of the batch's days compared.
    """
    with stateful_stream_conf(events.sparkSession, state_partitions):
        topic = checkouts_of_topic(events, lookback=lookback, lateness=lateness)
        rows = settled_first_rows(topic, CHECKOUTS.key, CHECKOUTS.event_time, CHECKOUTS.first_by)
        write = table_writer(store, "checkouts", SETTLED_CHECKOUTS)
        return write_tables(rows, write, checkpoint, trigger, "checkouts table")


def start_rollups(
    checkouts: DataFrame,
    store: Store,
    checkpoint: str,
    window: str = WINDOW,
    trigger: Trigger = ROLLUP_TRIGGER,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Maintain the five roll-up tables of a store from a stream of checkouts.

    ``checkouts`` is either :func:`checkout_stream`, which chains attribution
    and roll-up in one query, or :func:`checkouts_of_topic`.
    """
    with stateful_stream_conf(checkouts.sparkSession, state_partitions):
        cube = rollup_cube(checkouts, window)
        return write_tables(cube, rollup_writer(store), checkpoint, trigger, "roll-ups")


def start_provisional_rollups(
    checkouts: DataFrame,
    path: str,
    checkpoint: str,
    window: str = WINDOW,
    trigger: Trigger = ROLLUP_TRIGGER,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Publish the roll-up cube in update mode, as a changelog under ``path``.

    Whenever a window's counts change, their new values are appended as a newer
    version; :func:`provisional_rollup` reads the latest. Rows are visible as
    soon as their events have come, before their window closes, and late events
    correct them as long as the watermark allows. ``checkouts`` must come from a
    topic (:func:`checkouts_of_topic`): a join chained before does not know
    update mode.
    """
    with stateful_stream_conf(checkouts.sparkSession, state_partitions):
        cube = rollup_cube(checkouts, window)

        def write(changes: DataFrame, batch_id: int) -> None:
            write_batch(changes, path, CUBE, batch_id, query=query_id(changes))

        return write_tables(cube, write, checkpoint, trigger, "provisional roll-ups", "update")


def provisional_rollup(
    spark: SparkSession, path: str, table: str, query: str | None = None, contract: TableContract = CUBE
) -> DataFrame:
    """One of the five roll-ups as the changelog under ``path`` knows it now.

    Versions are ordered within one query. If several have written there, as
    after a move to a new checkpoint, ``query`` names the one to read.
    """
    changes = read_table(spark, path, contract)
    if query is not None:
        changes = changes.where(F.col("query") == query)
    elif len(writers(spark, path)) > 1:
        raise ValueError(f"{path} has changes of several queries; name one of {sorted(writers(spark, path))}")
    return rollup_from_cube(latest_versions(changes, CUBE.key, "batch_id").select(*CUBE.columns), table)


def await_any(spark: SparkSession) -> None:
    """Block until one of the session's streams ends; its failure is raised."""
    spark.streams.awaitAnyTermination()


class LateRows(StreamingQueryListener):
    """Counts the rows that stateful operators drop as too late, per query, from the moment it is added.

    Spark keeps the progress of some hundred micro-batches only; this adds up
    all of them: ``counter = LateRows(); spark.streams.addListener(counter)``.
    """

    def __init__(self) -> None:
        self._dropped: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        states = event.progress.stateOperators
        self._dropped[str(event.progress.id)] += sum(state.numRowsDroppedByWatermark for state in states)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> int:
        """Rows of a query dropped so far; listeners hear of a micro-batch a moment after its end."""
        return self._dropped[str(query.id)]


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as too late in the progress that Spark still keeps; :class:`LateRows` counts all."""
    return sum(
        state.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for state in progress.stateOperators
    )


def state_rows(query: StreamingQuery) -> int:
    """Rows the query holds in state now."""
    progress = query.lastProgress
    return 0 if progress is None else sum(state.numRowsTotal for state in progress.stateOperators)
