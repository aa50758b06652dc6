"""Streams against the batch operators on the same events."""

import datetime as dt
import json
import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clicktrail.functions.codec import decode_clicks, decode_purchases, decode_rows
from clicktrail.operators.attribution import min_click
from clicktrail.operators.contracts import first_per_key
from clicktrail.operators.rollups import rollup
from clicktrail.plans.checkouts import trailing_checkouts, windowed_checkouts
from clicktrail.operators.contracts import settled_first_rows
from clicktrail.schemas import CHECKOUTS, CUBE, PRODUCTS, ROLLUPS, USERS
from clicktrail.sinks import tables
from clicktrail.session import stateful_stream_conf, work_dir
from clicktrail.sinks.tables import load_dimension, parquet_store, read_dimension
from clicktrail.sinks.topics import append_topic
from clicktrail.sources.tables import file_system, read_rows, read_table
from clicktrail.sources.topics import load_topics, read_topics
from clicktrail.streaming.pipeline import (
    LateRows,
    await_any,
    checkout_stream,
    checkout_stream_of_final_clicks,
    checkouts_of_topic,
    late_rows,
    provisional_rollup,
    settled_min_clicks,
    start_checkout_table,
    start_checkouts,
    start_final_clicks,
    start_min_clicks,
    start_provisional_rollups,
    start_rollups,
    state_rows,
    write_tables,
)
from clicktrail.streaming.state import shard_rows, state_of, state_operators
from clicktrail.streaming.trailing import start_trailing_checkouts, within
from clicktrail.streaming.triggers import AVAILABLE_NOW
from helpers import NOON, products, rows, users

BOTH = "clicks, purchases"
MINUTE = dt.timedelta(minutes=1)
FAR = NOON + dt.timedelta(days=365)


def click_message(i, user, when):
    return json.dumps(
        {
            "Click_ID": f"c{i}",
            "User_ID": user,
            "Click_time": when.isoformat(),
            "Click_at": "Product",
            "Source": ["Google", "Tiktok"][i % 2],
            "IP": "10.0.0.1",
        }
    )


def purchase_message(i, user, when):
    return json.dumps(
        {
            "Purchase_ID": f"p{i}",
            "User_ID": user,
            "Product_ID": f"p{i % 2}",
            "Shipping_cost": "2.5",
            "Discount": "0.05",
            "Total_cost": "1.0",
            "Payment_method": "Visa",
            "Quantity": str(1 + i % 3),
            "Payment_status": "failure" if i % 7 == 0 else "success",
            "Description": "Card Expired" if i % 7 == 0 else "none",
            "Purchase_time": when.isoformat(),
        }
    )


ENCODE = {"clicks": click_message, "purchases": purchase_message}


def make_events(seed=1, n=300, minutes=90):
    rng = random.Random(seed)

    def one(kind, i):
        when = NOON + dt.timedelta(milliseconds=rng.randrange(minutes * 60_000))
        return (when, kind, i, rng.choice(["hot", "hot", "a", "b", "stranger"]))

    return sorted(one(kind, i) for kind in ENCODE for i in range(n))


def publish(spark, root, events):
    """Append events to their topics, one file per topic and call."""
    for topic, encode in ENCODE.items():
        values = [(encode(i, user, when),) for when, kind, i, user in events if kind == topic]
        if values:
            append_topic(spark.createDataFrame(values, "value STRING").coalesce(1), root, topic)


def flush(spark, root, when=FAR):
    publish(spark, root, [(when, kind, 10_000_000 + when.toordinal(), "stranger") for kind in ENCODE])


def chunks(events, n):
    size = -(-len(events) // n)
    return [events[i : i + size] for i in range(0, len(events), size)]


@pytest.fixture(scope="module")
def dims(spark):
    return users(spark, "hot", "a", "b"), products(spark, "p0", "p1")


@pytest.fixture(scope="module")
def replay(spark):
    """Topics of five time-ordered chunks with disorder inside each, then a flush."""
    root, events = work_dir(spark, "topics"), make_events()
    for part in chunks(events, 5):
        random.Random(7).shuffle(part)
        publish(spark, root, part)
    flush(spark, root)
    return root


@pytest.fixture(scope="module")
def batch(spark, replay, dims):
    """Clicks, purchases and windowed checkouts of the same messages as tables."""
    messages = load_topics(spark, replay, BOTH)
    c, p = decode_clicks(messages).cache(), decode_purchases(messages).cache()
    return c, p, windowed_checkouts(c, p, *dims).cache()


def streams(spark, root, files_per_batch=None):
    """The click and the purchase topic."""
    return [read_topics(spark, root, topic, files_per_batch) for topic in ENCODE]


def store_checkouts(spark, root, store, checkpoint, files_per_batch=None, **options):
    """The table query over the whole checkouts topic; then a flush message comes, and it runs again."""
    last = f"{root}/flush-{checkpoint.replace('/', '-')}"
    location, fs = file_system(spark, f"{last}/checkouts")
    fs.mkdirs(location)
    message = json.dumps({"purchase_id": "flush", "purchase_time": FAR.isoformat()})
    for _ in range(2):
        topic = read_topics(spark, root, "checkouts", files_per_batch).unionByName(read_topics(spark, last, "checkouts"))
        query = run(start_checkout_table(topic, store, f"{root}/{checkpoint}", AVAILABLE_NOW, **options))
        if len(fs.listStatus(location)) == 0:
            append_topic(spark.createDataFrame([(message,)], "value STRING"), last, "checkouts")
    return query


def run(query):
    query.awaitTermination()
    return query


def test_checkouts_stream_equals_batch_for_any_chunking(spark, replay, dims, batch):
    *_, expected = batch
    for files, salts in ((1, 1), (None, 3)):
        root = work_dir(spark, "out")
        events = streams(spark, replay, files)
        query = run(start_checkouts(*events, *dims, root, f"{root}/cp", trigger=AVAILABLE_NOW, salts=salts))
        got = decode_rows(load_topics(spark, root, "checkouts"), "checkouts", CHECKOUTS.schema)
        keys = ("purchase_id", "click_id", "click_time", "purchase_time", "total_cost", "profit", "name")
        want = expected.withColumns({m: F.col(m).cast("double") for m in ("total_cost", "profit")})
        assert rows(got, *keys) == rows(want, *keys)
        assert len(rows(got)) > 50
        assert late_rows(query) == 0


def test_chained_rollups_equal_batch(spark, replay, dims, batch):
    *_, expected = batch
    root = work_dir(spark, "rollups")
    checkouts = checkout_stream(*streams(spark, replay, 1), *dims)
    query = run(start_rollups(checkouts, parquet_store(root), f"{root}/cp", trigger=AVAILABLE_NOW))
    assert late_rows(query) == 0
    for table, contract in ROLLUPS.items():
        got, want = read_rows(spark, f"{root}/{table}", contract), rollup(expected, table)
        if table == "revenue":
            money = [f"cast({name} as decimal(38, 12)) {name}" for name in ("revenue", "profit")]
            want = want.selectExpr(*money, "bigint(quantity) quantity", "time")
        assert rows(got) == rows(want) != []


def test_state_is_bounded_and_empty_after_the_flush(spark, replay, dims):
    root = work_dir(spark, "state")
    events = streams(spark, replay, 1)
    query = run(start_checkouts(*events, *dims, root, f"{root}/cp", trigger=AVAILABLE_NOW))
    assert all("rocksdbGetCount" in s.customMetrics for s in query.lastProgress.stateOperators)
    held = [sum(s.numRowsTotal for s in p.stateOperators) for p in query.recentProgress]
    assert max(held) < 600 and state_rows(query) <= 2  # the two flush events


def test_table_and_rollups_from_the_checkouts_topic(spark, replay, dims, batch):
    *_, expected = batch
    root = work_dir(spark, "topic")
    run(start_checkouts(*streams(spark, replay), *dims, root, f"{root}/cp1", trigger=AVAILABLE_NOW))
    for _ in range(2):  # the second run has nothing left to do
        store_checkouts(spark, root, parquet_store(f"{root}/t"), "cp2")
        keys = ("purchase_id", "click_id")
        first = first_per_key(expected, CHECKOUTS.key, CHECKOUTS.first_by)
        assert rows(read_rows(spark, f"{root}/t/checkouts", CHECKOUTS), *keys) == rows(first, *keys)
    checkouts = checkouts_of_topic(read_topics(spark, root, "checkouts"))
    query = run(start_rollups(checkouts, parquet_store(f"{root}/rolled"), f"{root}/cp3", trigger=AVAILABLE_NOW))
    assert late_rows(query) == 0
    newest = expected.agg(F.max("purchase_time")).first()[0]
    closed = rollup(expected, "source_count").where(F.col("time") <= F.lit(newest - 20 * MINUTE))
    assert rows(read_rows(spark, f"{root}/rolled/source_count", ROLLUPS["source_count"])) == rows(closed) != []


def test_first_clicks_on_their_own_topic(spark, dims, batch, replay):
    """Entry by entry: clicks to final clicks, then purchases against that topic."""
    *_, expected = batch
    root = work_dir(spark, "entries")
    run(start_final_clicks(streams(spark, replay, 1)[0], root, f"{root}/cp1", trigger=AVAILABLE_NOW))
    last = {"click_id": "x", "user_id": "stranger", "click_time": FAR.isoformat()}
    append_topic(spark.createDataFrame([(json.dumps(last),)], "value STRING"), f"{root}/more", "final_clicks")
    firsts = read_topics(spark, root, "final_clicks").unionByName(read_topics(spark, f"{root}/more", "final_clicks"))
    checkouts = checkout_stream_of_final_clicks(firsts, streams(spark, replay)[1], *dims)
    query = run(start_rollups(checkouts, parquet_store(root), f"{root}/cp2", trigger=AVAILABLE_NOW))
    assert late_rows(query) == 0
    table = "category_count"
    assert rows(read_rows(spark, f"{root}/{table}", ROLLUPS[table])) == rows(rollup(expected, table)) != []


def test_restart_continues_without_repeats(spark, dims):
    root, events = work_dir(spark, "restart"), make_events(seed=3)
    parts = chunks(events, 3)
    for step, part in enumerate([*parts, None]):
        if part is None:
            flush(spark, root)
        else:
            publish(spark, root, part)
        stream = streams(spark, root)
        run(start_checkouts(*stream, *dims, f"{root}/out", f"{root}/cp", trigger=AVAILABLE_NOW))
    messages = load_topics(spark, root, BOTH)
    expected = windowed_checkouts(decode_clicks(messages), decode_purchases(messages), *dims)
    got = decode_rows(load_topics(spark, f"{root}/out", "checkouts"), "checkouts", CHECKOUTS.schema)
    assert rows(got, "purchase_id", "click_id") == rows(expected, "purchase_id", "click_id")


def test_trailing_stream_equals_batch(spark, replay, dims, batch):
    c, p, _ = batch
    root = work_dir(spark, "trailing")
    events = streams(spark, replay, 1)
    query = run(start_trailing_checkouts(*events, *dims, root, f"{root}/cp", trigger=AVAILABLE_NOW))
    assert late_rows(query) == 0
    got = read_rows(spark, f"{root}/checkouts", CHECKOUTS)
    keys = ("purchase_id", "click_id", "source")
    assert rows(got, *keys) == rows(trailing_checkouts(c, p, *dims), *keys) != []


def test_trailing_stream_merge_joins_dimensions_that_are_large_as_rows(spark, replay, dims, monkeypatch):
    path, plans = work_dir(spark, "trailing-dims"), []
    wide = dims[0].withColumn("location", F.lit("x" * 2000))
    many = wide.crossJoin(spark.range(200)).withColumn("user_id", F.concat("user_id", F.lit("-"), F.col("id").cast("string"))).drop("id")
    many.unionByName(wide).coalesce(1).write.parquet(path)
    people = spark.read.parquet(path)
    dims[1].write.parquet(f"{path}-goods")
    goods = spark.read.parquet(f"{path}-goods")

    def attributed(*args):
        found = trailing_checkouts(*args)
        plans.append(found._jdf.queryExecution().optimizedPlan().toString())
        return found

    monkeypatch.setattr("clicktrail.streaming.trailing.trailing_checkouts", attributed)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "200000")
    try:
        assert int(str(people._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 200_000
        root = work_dir(spark, "trailing")
        run(start_trailing_checkouts(*streams(spark, replay, 1), people, goods, root, f"{root}/cp", trigger=AVAILABLE_NOW))
    finally:
        spark.conf.set(threshold, before)
    # the people and the batch's purchases; the products are small
    assert plans and all(p.count("strategy=merge") == 2 and p.count("strategy=broadcast") == 1 for p in plans)
    messages = load_topics(spark, replay, BOTH)
    expected = trailing_checkouts(decode_clicks(messages), decode_purchases(messages), people, goods)
    got = read_rows(spark, f"{root}/checkouts", CHECKOUTS)
    assert rows(got, "purchase_id", "click_id", "name") == rows(expected, "purchase_id", "click_id", "name") != []


def test_late_events_are_dropped_and_counted(spark, dims):
    root = work_dir(spark, "late")
    publish(spark, root, [(NOON, "clicks", 1, "a"), (NOON + MINUTE, "purchases", 1, "a")])
    flush(spark, root, NOON + 60 * MINUTE)
    flush(spark, root, NOON + 61 * MINUTE)
    publish(spark, root, [(NOON - MINUTE, "clicks", 2, "a"), (NOON + 62 * MINUTE, "purchases", 2, "a")])
    flush(spark, root)
    events = streams(spark, root, 1)
    query = run(start_checkouts(*events, *dims, root, f"{root}/cp", trigger=AVAILABLE_NOW))
    got = decode_rows(load_topics(spark, root, "checkouts"), "checkouts", CHECKOUTS.schema)
    assert rows(got, "purchase_id", "click_id") == [("p1", "c1")]
    assert late_rows(query) >= 1


def test_redelivered_events_count_once(spark, dims):
    root = work_dir(spark, "again")
    event = [(NOON, "clicks", 1, "a"), (NOON + MINUTE, "purchases", 1, "a")]
    publish(spark, root, event)
    publish(spark, root, event)
    flush(spark, root)
    stream = streams(spark, root, 1)
    run(start_checkouts(*stream, *dims, root, f"{root}/cp", trigger=AVAILABLE_NOW, redelivery=True))
    got = decode_rows(load_topics(spark, root, "checkouts"), "checkouts", CHECKOUTS.schema)
    assert rows(got, "purchase_id") == [("p1",)]
    run(start_trailing_checkouts(*stream, *dims, f"{root}/t", f"{root}/cp2", trigger=AVAILABLE_NOW))
    assert rows(read_rows(spark, f"{root}/t/checkouts", CHECKOUTS), "purchase_id") == [("p1",)]


def test_minima_can_be_streamed_in_update_mode(spark):
    root = work_dir(spark, "minima")
    publish(spark, root, [(NOON + 5 * MINUTE, "clicks", 1, "a")])
    publish(spark, root, [(NOON + MINUTE, "clicks", 2, "a")])
    seen = []

    def note(batch, batch_id):
        seen.append(rows(batch, "min_user_id", "min_click_time"))

    stream = decode_clicks(read_topics(spark, root, "clicks", files_per_batch=1))
    with stateful_stream_conf(spark):
        query = (
            min_click(stream.withWatermark("click_time", "10 minutes"))
            .writeStream.foreachBatch(note)
            .outputMode("update")
            .option("checkpointLocation", f"{root}/cp")
            .trigger(availableNow=True)
            .start()
        )
    run(query)
    assert [s for s in seen if s] == [[("a", NOON + 5 * MINUTE)], [("a", NOON + MINUTE)]]


def test_a_new_checkpoint_adds_to_a_table(spark, dims):
    """Batch numbers begin at 0 again; what the earlier query stored stays, and nothing is stored twice."""
    root = work_dir(spark, "again")
    publish(spark, root, make_events(seed=5, n=80))
    flush(spark, root)
    run(start_checkouts(*streams(spark, root), *dims, root, f"{root}/cp", trigger=AVAILABLE_NOW))
    store, found = parquet_store(f"{root}/t"), []
    for checkpoint, shards in (("one/checkpoint", 2), ("two/checkpoint", 3), ("two/checkpoint", 3)):
        store_checkouts(spark, root, store, checkpoint, 1, state_partitions=shards)
        assert {r.numPartitions for r in state_operators(spark, f"{root}/{checkpoint}").collect()} == {shards}
        found.append(rows(read_rows(spark, f"{root}/t/checkouts", CHECKOUTS), "purchase_id", "click_id"))
    assert found[0] == found[1] == found[2] != []
    late_root = work_dir(spark, "later")
    publish(spark, late_root, [(NOON, "clicks", 900, "a"), (NOON + MINUTE, "purchases", 900, "a")])
    flush(spark, late_root)
    run(start_checkouts(*streams(spark, late_root), *dims, late_root, f"{late_root}/cp", trigger=AVAILABLE_NOW))
    store_checkouts(spark, late_root, store, "three/checkpoint")
    got = rows(read_rows(spark, f"{root}/t/checkouts", CHECKOUTS), "purchase_id", "click_id")
    assert got == sorted([*found[0], ("p900", "c900")])


def test_a_table_sink_continues_after_a_restart(spark, dims):
    root, parts = work_dir(spark, "resume"), chunks(make_events(seed=6, n=120), 2)
    for part in [*parts, None]:
        publish(spark, root, part) if part else flush(spark, root)
        chained = checkout_stream(*streams(spark, root, 1), *dims)
        run(start_rollups(chained, parquet_store(f"{root}/t"), f"{root}/cp", trigger=AVAILABLE_NOW))
    messages = load_topics(spark, root, BOTH)
    expected = windowed_checkouts(decode_clicks(messages), decode_purchases(messages), *dims)
    for table in ("source_count", "gender_count"):
        got = read_rows(spark, f"{root}/t/{table}", ROLLUPS[table])
        assert rows(got) == rows(rollup(expected, table)) != []


def test_events_without_id_settle_one_by_one(spark, dims):
    root = work_dir(spark, "nameless")
    publish(spark, root, [(NOON, "clicks", 1, "a")])
    bought = [json.loads(purchase_message(1, "a", NOON + MINUTE)) | {"Purchase_ID": None, "Quantity": q} for q in "112"]
    append_topic(spark.createDataFrame([(json.dumps(b),) for b in bought], "value STRING"), root, "purchases")
    flush(spark, root)
    run(start_trailing_checkouts(*streams(spark, root), *dims, f"{root}/t", f"{root}/cp", trigger=AVAILABLE_NOW))
    assert rows(read_rows(spark, f"{root}/t/checkouts", CHECKOUTS), "quantity", "click_id") == [
        (1.0, "c1"), (1.0, "c1"), (2.0, "c1"),
    ]


def test_a_user_loaded_between_batches_is_joined(spark):
    """A dimension is reloaded while the stream runs: it goes on, with the newest version in each micro-batch."""
    root = work_dir(spark, "live")
    load_dimension(users(spark, "a"), f"{root}/users", USERS)
    load_dimension(products(spark, "p0", "p1"), f"{root}/products", PRODUCTS)
    dimensions = [
        lambda name=name, contract=contract: read_dimension(spark, f"{root}/{name}", contract)
        for name, contract in (("users", USERS), ("products", PRODUCTS))
    ]
    for path in ("clicks", "purchases"):
        append_topic(spark.createDataFrame([], "value STRING"), root, path)
    query = start_trailing_checkouts(*streams(spark, root, 1), *dimensions, f"{root}/t", f"{root}/cp")
    try:
        for n, user in enumerate(("a", "b")):
            if user == "b":
                load_dimension(users(spark, "a", "b"), f"{root}/users", USERS)
            when = NOON + dt.timedelta(hours=2 * n)
            publish(spark, root, [(when, "clicks", n, user), (when + MINUTE, "purchases", n, user)])
            flush(spark, root, when + dt.timedelta(hours=1))
            query.processAllAvailable()
        flush(spark, root)
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(read_rows(spark, f"{root}/t/checkouts", CHECKOUTS), "purchase_id", "name") == [
        ("p0", "name a"), ("p1", "name b"),
    ]


def test_queries_are_named_by_their_whole_checkpoint(spark, replay):
    root = work_dir(spark, "names")
    queries = [
        start_final_clicks(streams(spark, replay)[0], f"{root}/{n}", f"{root}/{n}/checkpoint", state_partitions=1)
        for n in ("one", "two")
    ]
    try:
        assert len({q.name for q in queries}) == 2
    finally:
        for q in queries:
            q.stop()


def test_a_listener_counts_all_late_rows(spark, dims):
    root, counter = work_dir(spark, "late"), LateRows()
    publish(spark, root, [(NOON, "clicks", 1, "a")])
    flush(spark, root, NOON + 60 * MINUTE)
    flush(spark, root, NOON + 61 * MINUTE)
    publish(spark, root, [(NOON - MINUTE, "clicks", 2, "a"), (NOON - MINUTE, "purchases", 2, "a")])
    spark.streams.addListener(counter)
    try:
        query = run(start_checkouts(*streams(spark, root, 1), *dims, root, f"{root}/cp", trigger=AVAILABLE_NOW))
        deadline = time.monotonic() + 20
        while counter.of(query) < late_rows(query) and time.monotonic() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counter)
    assert counter.of(query) == late_rows(query) >= 1


def test_minima_are_published_and_settle(spark, replay):
    root = work_dir(spark, "published")
    for _ in range(2):
        run(start_min_clicks(streams(spark, replay, 1)[0], root, f"{root}/cp", trigger=AVAILABLE_NOW))
    published = load_topics(spark, root, "min_clicks")
    clicks = decode_clicks(load_topics(spark, replay, "clicks"))
    assert rows(settled_min_clicks(published)) == rows(min_click(clicks)) != []
    assert published.count() > min_click(clicks).count()


def test_processing_time_trigger_and_waiting_for_a_failure(spark, replay):
    root = work_dir(spark, "timed")
    spark.streams.resetTerminated()

    def fail(batch, batch_id):
        raise RuntimeError("no more")

    query = write_tables(streams(spark, replay)[0], fail, f"{root}/cp", "1 second", "failing")
    with pytest.raises(StreamingQueryException, match="no more"):
        await_any(spark)
    spark.streams.resetTerminated()
    assert not query.isActive


def test_lateness_of_the_checkouts_topic_follows_the_lookback(spark, replay):
    topic = checkouts_of_topic(read_topics(spark, replay, "clicks"), lookback="1 day")
    text = plan_of(topic)
    assert "EventTimeWatermark" in text and ("48 hours" in text or "2 days" in text)


def plan_of(df):
    return df._jdf.queryExecution().analyzed().toString()


def checkout_message(purchase, click, bought, clicked):
    return json.dumps({"purchase_id": purchase, "click_id": click, "purchase_time": bought.isoformat(), "click_time": clicked.isoformat()})


def test_the_table_sink_never_reads_what_it_stored(spark, monkeypatch):
    """The earlier click comes in a later micro-batch; keyed state decides, and rows without id all stay."""
    root = work_dir(spark, "keyed")
    for part in (
        [("p1", "c2", NOON, NOON - 2 * MINUTE), (None, "c9", NOON, NOON - MINUTE), (None, "c9", NOON, NOON - MINUTE)],
        [("p1", "c1", NOON, NOON - 8 * MINUTE), ("p2", "c3", NOON + MINUTE, NOON), (None, "c8", NOON, NOON - MINUTE)],
        [("p3", "c4", NOON + dt.timedelta(days=1), NOON + dt.timedelta(days=1))],
    ):
        append_topic(spark.createDataFrame([(checkout_message(*row),) for row in part], "value STRING").coalesce(1), root, "checkouts")
    monkeypatch.setattr(tables, "read_days", lambda *args: pytest.fail("the sink read its table"))
    query = store_checkouts(spark, root, parquet_store(f"{root}/t"), "cp", 1, lateness="20 minutes")
    got = rows(read_rows(spark, f"{root}/t/checkouts", CHECKOUTS), "purchase_id", "click_id")
    assert got == sorted([("p1", "c1"), ("p2", "c3"), ("p3", "c4"), (None, "c9"), (None, "c9"), (None, "c8")], key=repr)
    assert state_rows(query) == 1  # the flush message


def test_first_rows_by_state_equal_first_rows_of_a_table(spark):
    data = [("k", NOON, 2, "b"), ("k", NOON, 1, "z"), ("k", NOON + MINUTE, 3, "a"), ("m", NOON, None, "a"), (None, NOON, 1, "n"), (None, NOON, 1, "n")]
    df = spark.createDataFrame(data, "key string, at timestamp, place int, other string")
    got = rows(settled_first_rows(df, ["key"], "at", ["place"]))
    assert got == rows(first_per_key(df, ["key", "at"], ["place"]))


def test_provisional_rollups_are_early_and_become_final(spark, dims):
    """Before any window closes the changelog has the counts so far; later events correct them."""
    root, parts = work_dir(spark, "provisional"), chunks(make_events(seed=8, n=150), 3)
    early = []
    for part in parts:
        publish(spark, root, part)
        run(start_checkouts(*streams(spark, root), *dims, root, f"{root}/cp", trigger=AVAILABLE_NOW))
        topic = checkouts_of_topic(read_topics(spark, root, "checkouts", files_per_batch=2))
        run(start_provisional_rollups(topic, f"{root}/cube", f"{root}/cp2", trigger=AVAILABLE_NOW))
        so_far = decode_rows(load_topics(spark, root, "checkouts"), "checkouts", CHECKOUTS.schema)
        for table in ("source_count", "fail_count"):
            assert rows(provisional_rollup(spark, f"{root}/cube", table)) == rows(rollup(so_far, table))
        early.append(rows(provisional_rollup(spark, f"{root}/cube", "source_count")))
    assert early[0] != early[1] != early[2] != []
    changes = read_table(spark, f"{root}/cube", CUBE)
    assert changes.count() > changes.select(*CUBE.key).distinct().count()  # some windows were corrected
    run(start_provisional_rollups(topic, f"{root}/cube", f"{root}/cp3", trigger=AVAILABLE_NOW))
    with pytest.raises(ValueError, match="several queries"):
        provisional_rollup(spark, f"{root}/cube", "revenue")
    for name in tables.writers(spark, f"{root}/cube"):
        assert rows(provisional_rollup(spark, f"{root}/cube", "source_count", name)) == early[2]


def test_state_can_be_read_and_has_the_shards_asked_for(spark, dims):
    root = work_dir(spark, "audit")
    publish(spark, root, [(NOON, "clicks", 1, "a"), (NOON + 20 * MINUTE, "clicks", 2, "b"), (NOON + 21 * MINUTE, "purchases", 1, "b")])
    run(start_checkouts(*streams(spark, root), *dims, root, f"{root}/cp", trigger=AVAILABLE_NOW, state_partitions=3))
    operators = {r.operatorName: r for r in state_operators(spark, f"{root}/cp").collect()}
    assert {r.numPartitions for r in operators.values()} == {3}
    [aggregate] = [r.operatorId for name, r in operators.items() if name == "stateStoreSave"]
    held = state_of(spark, f"{root}/cp", aggregate).select("key.user_id", F.col("key.window.start").alias("start"))
    assert rows(held, "user_id", "start") == [("b", NOON + 20 * MINUTE)]  # the window of "a" is closed
    [join] = [r.operatorId for name, r in operators.items() if name == "symmetricHashJoin"]
    sides = [state_of(spark, f"{root}/cp", join, side).count() for side in ("left", "right")]
    assert sides == [1, 2]  # the open purchase, and the released click under both buckets that it may serve
    assert shard_rows(spark, f"{root}/cp", aggregate).agg(F.sum("rows")).first()[0] == 1


def test_settled_clicks_are_skipped_by_their_time(spark):
    path = work_dir(spark, "clicks")
    spark.range(10).select(F.timestamp_micros(F.col("id") * 1_000_000).alias("click_time"), "id").write.parquet(path)
    some = spark.read.parquet(path).where(within("click_time", 2_000_000, 4_000_000) | within("click_time", 8_000_000, 8_000_000))
    plan = some._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(click_time" in pushed and "LessThanOrEqual(click_time" in pushed
    assert rows(some, "id") == [(2,), (3,), (4,), (8,)]
