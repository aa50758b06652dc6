import datetime as dt

import pytest
from pyspark.sql import functions as F

from clicktrail.functions.codec import decode_rows
from clicktrail.operators.attribution import first_click_per_window, interval_attribution
from clicktrail.operators.enrich import enrich_purchases
from clicktrail.operators.skew import as_salts, copied, hot_keys, salted, salts_for, tasks_of
from clicktrail.schemas import CHECKOUTS
from clicktrail.session import work_dir
from clicktrail.sources.topics import load_topics, read_topics
from clicktrail.streaming.pipeline import HotIn, remembered_salts, start_checkouts
from clicktrail.streaming.triggers import AVAILABLE_NOW
from helpers import NOON, clicks, products, purchases, rows, users
from test_streaming import ENCODE, make_events, publish, run


def of_users(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id string")


def test_hot_keys_are_exact_and_nulls_are_none(spark):
    many = of_users(spark, *["a"] * 40, *["b"] * 10, *["c"] * 9, *[None] * 500, *[f"u{i}" for i in range(41)])
    assert rows(hot_keys(many, "user_id", 10), "key", "value", "rows", "all_rows") == [
        ("user_id", "a", 40, 100), ("user_id", "b", 10, 100),
    ]


@pytest.mark.parametrize("one_in", [1, 7, 100])
def test_no_hot_key_is_missed_among_many_others(spark, one_in):
    ids = spark.range(300_000, numPartitions=5).select(
        F.when(F.col("id") % 50 == 0, F.lit("hot")).when(F.col("id") % 101 == 1, F.lit("cool")).otherwise(F.col("id").cast("string")).alias("user_id")
    )
    counts = ids.groupBy("user_id").count().where(F.col("count") * one_in >= 300_000)
    assert rows(hot_keys(ids, "user_id", one_in), "value", "rows") == rows(counts, "user_id", "count")


def test_empty_tables_have_no_hot_keys(spark):
    assert rows(hot_keys(of_users(spark), "user_id")) == rows(hot_keys(of_users(spark, None, None), "user_id")) == []
    assert as_salts(salts_for(purchases(spark), ("user_id", "product_id"), 8)) == {}


def test_tasks_follow_the_share_of_a_key(spark):
    many = of_users(spark, *["a"] * 60, *["b"] * 5, *[f"u{i}" for i in range(35)]).withColumn("product_id", F.lit("p"))
    salts = as_salts(salts_for(many, ("user_id", "product_id"), 10, one_in=20))
    assert salts == {"user_id": {"a": 6, "b": 2}, "product_id": {"p": 10}}


def test_only_hot_keys_are_copied(spark):
    salts = {"user_id": {"a": 3}}
    some = of_users(spark, "a", "a", "b", None)
    assert rows(copied(some, tasks_of(salts, "user_id")), "user_id", "_salt") == sorted(
        [("a", 0), ("a", 1), ("a", 2)] * 2 + [("b", 0), (None, 0)], key=repr
    )
    spread = salted(spark.range(200).select(F.col("id").alias("purchase_id"), F.when(F.col("id") < 100, "a").otherwise("b").alias("user_id")), tasks_of(salts, "user_id"), "purchase_id")
    assert rows(spread.select("user_id", "_salt").distinct()) == [(0, "a"), (0, "b"), (1, "a"), (2, "a")]
    assert tasks_of(salts, "product_id") is None and tasks_of(1, "user_id") is None


def test_joins_with_hot_keys_give_the_same_rows(spark):
    at = [NOON + dt.timedelta(seconds=30 * i) for i in range(60)]
    c = clicks(spark, *[(f"c{i}", "hot" if i % 3 else "a", t) for i, t in enumerate(at)])
    p = purchases(spark, *[(f"{i}", ("hot", "hot", "a", "b")[i % 4], t) for i, t in enumerate(at)])
    salts = {"user_id": {"hot": 5}, "product_id": {"p1": 3}}
    firsts = first_click_per_window(c)
    plain = interval_attribution(p, firsts)
    assert rows(plain) and rows(plain) == rows(interval_attribution(p, firsts, salts=salts))
    dims = users(spark, "hot", "a"), products(spark, "p1", "p2")
    assert rows(enrich_purchases(p, *dims)) == rows(enrich_purchases(p, *dims, salts=salts))


def test_salts_stay_those_of_the_first_start(spark):
    checkpoint = f"{work_dir(spark, 'salts')}/cp"
    first = purchases(spark, *[(str(i), "a", NOON) for i in range(10)])
    later = purchases(spark, *[(str(i), "b", NOON) for i in range(10)])
    want = {"user_id": {"a": 2}, "product_id": {"p1": 2}}
    assert remembered_salts(HotIn(first), checkpoint) == remembered_salts(HotIn(later), checkpoint) == want


def test_a_stream_with_hot_keys_equals_one_without(spark, monkeypatch):
    topic, out = work_dir(spark, "topics"), work_dir(spark, "out")
    events = make_events(seed=5, n=200)
    publish(spark, topic, events[:100])
    publish(spark, topic, events[100:])
    dims = users(spark, "hot", "a", "b"), products(spark, "p0", "p1")
    hot = HotIn(purchases(spark, *[(str(i), "hot" if i % 3 else f"u{i}", NOON) for i in range(30)]), one_in=10)
    # dimensions beyond the broadcast threshold are merge-joined
    monkeypatch.setattr("clicktrail.operators.enrich._is_small", lambda table: False)
    got = []
    for name, hot_in in (("plain", None), ("hot", hot)):
        streams = [read_topics(spark, topic, t, 1) for t in ENCODE]
        run(start_checkouts(*streams, *dims, f"{out}/{name}", f"{out}/cp-{name}", trigger=AVAILABLE_NOW, hot_in=hot_in))
        stored = decode_rows(load_topics(spark, f"{out}/{name}", "checkouts"), "checkouts", CHECKOUTS.schema)
        got.append(rows(stored, "purchase_id", "click_id", "name", "total_cost"))
    assert got[0] == got[1] and len(got[0]) > 20
    assert rows(spark.read.parquet(f"{out}/cp-hot-salts"), "key", "value") == [("product_id", "p1"), ("user_id", "hot")]
    with pytest.raises(ValueError, match="without salts"):
        start_checkouts(*streams, *dims, f"{out}/plain", f"{out}/cp-plain", trigger=AVAILABLE_NOW, hot_in=hot)
