import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter

from clicktrail.operators.contracts import conform, first_per_key, key_violations, new_rows
from clicktrail.schemas import CHECKOUTS, PRODUCTS, ROLLUPS, USERS
from clicktrail.session import work_dir
from clicktrail.sinks import tables, topics
from clicktrail.sinks.tables import compact_day, drop_expired, drop_old_versions, load_dimension, read_dimension, write_batch
from clicktrail.sources import tables as sources
from clicktrail.sources.tables import (
    CSV_OPTIONS,
    JdbcRange,
    csv_misfits,
    folders,
    hash_predicates,
    jdbc_options,
    newest_day,
    read_csv,
    read_csv_table,
    read_days,
    read_rows,
    read_since,
    read_table,
    stored_days,
)
from clicktrail.sources.topics import kafka_options, topic_names
from helpers import NOON, at, products, rows

SOURCES = ROLLUPS["source_count"]


def counts(spark, *data):
    return spark.createDataFrame(list(data), SOURCES.schema)


def test_conform_orders_and_types_columns(spark):
    data = [("2024-01-01 00:00:00", "7", "Google"), ("bad", "x", "Gmail")]
    df = spark.createDataFrame(data, ["time", "count", "source"])
    out = conform(df, SOURCES)
    assert out.columns == ["source", "count", "time"]
    assert [f.dataType for f in out.schema] == [f.dataType for f in SOURCES.schema]
    assert rows(out, *out.columns) == [("Gmail", None, None), ("Google", 7, dt.datetime(2024, 1, 1))]


def test_key_violations_are_repeats_and_nulls(spark):
    df = counts(spark, ("a", 1, NOON), ("a", 2, NOON), ("b", 1, NOON), (None, 1, NOON))
    assert rows(key_violations(df, SOURCES.key), "source", "rows") == [("a", 2), (None, 1)]


def test_new_rows_skip_stored_and_repeated_keys(spark):
    batch = counts(spark, ("a", 1, NOON), ("b", 1, NOON), ("b", 1, NOON))
    stored = counts(spark, ("a", 1, NOON))
    assert rows(new_rows(batch, stored, SOURCES.key), "source") == [("b",)]


def test_replayed_batch_replaces_itself_only(spark):
    path = work_dir(spark, "t")
    write_batch(counts(spark, ("a", 1, at("10:00"))), path, SOURCES, 0)
    write_batch(counts(spark, ("b", 2, at("11:00"))), path, SOURCES, 1)
    write_batch(counts(spark, ("b", 2, at("11:00"))), path, SOURCES, 1)
    assert rows(read_rows(spark, path, SOURCES), "source", "count") == [("a", 1), ("b", 2)]


def test_table_reads_prune_days(spark):
    path = work_dir(spark, "t")
    days = [NOON + dt.timedelta(days=d) for d in range(3)]
    write_batch(counts(spark, *[("a", i, t) for i, t in enumerate(days)]), path, SOURCES, 0, gather_days=True)
    one = read_table(spark, path, SOURCES).where("date = '2024-01-02'")
    assert rows(one, "count") == [(1,)]
    assert len(one.inputFiles()) == 3 and "PartitionFilters: [isnotnull(date" in plan(one)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_expired_days_are_dropped_and_the_boundary_rewritten(spark):
    path = work_dir(spark, "t")
    as_of, hour = NOON, dt.timedelta(hours=1)
    cut = as_of - dt.timedelta(days=2)
    write_batch(counts(spark, ("old", 1, cut - 30 * hour), ("edge", 1, cut)), path, SOURCES, 0)
    write_batch(counts(spark, ("gone", 1, cut - dt.timedelta(microseconds=1))), path, SOURCES, 1)
    write_batch(counts(spark, ("mixed-gone", 1, cut - hour), ("mixed-kept", 1, cut + hour)), path, SOURCES, 2)
    write_batch(counts(spark, ("new", 1, as_of)), path, SOURCES, 3)
    for _ in range(2):
        drop_expired(spark, path, SOURCES, as_of)
        assert rows(read_rows(spark, path, SOURCES), "source") == [("edge",), ("mixed-kept",), ("new",)]


def test_csv_seed_to_dimension_table(spark):
    seed, path = work_dir(spark, "seed"), work_dir(spark, "dim")
    tricky = products(spark, "p1").withColumnRenamed("product_name", "Product_name")
    tricky = tricky.na.replace("thing p1", 'he said "hi", twice', "Product_name")
    tricky.write.options(**CSV_OPTIONS).csv(seed)
    text = read_csv(spark, seed, PRODUCTS.columns)
    assert {t for _, t in text.dtypes} == {"string"}
    load_dimension(read_csv_table(spark, seed, PRODUCTS), path, PRODUCTS)
    stored = read_dimension(spark, path, PRODUCTS)
    assert rows(stored, "product_name", "price") == [('he said "hi", twice', Decimal("10.0000"))]


def test_csv_values_of_every_kind_come_back(spark):
    seed = work_dir(spark, "seed")
    values = ["a,b", 'q"q', "two\nlines", "\r\n", "", None, " x ", '"', "é", "\\"]
    data = [(f"p{n}", v, v, v, None, None) for n, v in enumerate(values)]
    spark.createDataFrame(data, PRODUCTS.schema).coalesce(1).write.options(**CSV_OPTIONS).csv(seed)
    got = {r.product_id: r.product_name for r in read_csv_table(spark, seed, PRODUCTS).collect()}
    assert got["p2"] == "two\nlines" and got["p0"] == "a,b" and got["p1"] == 'q"q' and got["p7"] == '"'
    assert len(got) == len(values) and got["p4"] is None and got["p5"] is None and got["p9"] == "\\"
    assert csv_misfits(spark, seed, PRODUCTS.columns).collect() == []


def test_csv_rows_that_do_not_parse_are_reported(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("a,b\n1,2\n3\n4,5,6\n")
    found = csv_misfits(spark, str(tmp_path), ["a", "b"]).collect()
    assert sorted(r["_misfit"].strip() for r in found) == ["3", "4,5,6"]


def test_a_new_version_leaves_readers_of_the_old_one_alone(spark):
    path = work_dir(spark, "dim")
    load_dimension(products(spark, "p1"), path, PRODUCTS)
    old = read_dimension(spark, path, PRODUCTS)
    load_dimension(products(spark, "p1", "p2"), path, PRODUCTS)
    assert (old.count(), read_dimension(spark, path, PRODUCTS).count()) == (1, 2)
    load_dimension(products(spark, "p3"), path, PRODUCTS)
    drop_old_versions(spark, path, keep=1)
    assert rows(read_dimension(spark, path, PRODUCTS), "product_id") == [("p3",)]
    with pytest.raises(FileNotFoundError):
        read_dimension(spark, work_dir(spark, "none"), PRODUCTS)


def test_another_query_never_overwrites_stored_batches(spark):
    path = work_dir(spark, "t")
    write_batch(counts(spark, ("a", 1, at("10:00"))), path, SOURCES, 0, query="one")
    write_batch(counts(spark, ("b", 2, at("11:00"))), path, SOURCES, 0, query="two")
    write_batch(counts(spark, ("b", 3, at("11:00"))), path, SOURCES, 0, query="two")
    assert rows(read_rows(spark, path, SOURCES), "source", "count") == [("a", 1), ("b", 3)]


def checkout(spark, *data):
    """Checkouts of (purchase_id, click_id, click_time)."""
    nulls = dict.fromkeys(CHECKOUTS.columns)
    full = [
        tuple((nulls | {"purchase_id": p, "click_id": c, "click_time": t, "purchase_time": NOON}).values())
        for p, c, t in data
    ]
    return spark.createDataFrame(full, CHECKOUTS.schema)


TWICE = [("p1", "c2", at("11:52")), ("p1", "c1", at("11:50")), ("p2", "c3", at("11:53"))]


def test_both_stores_keep_the_first_click_of_a_purchase(spark, monkeypatch):
    path, sent = work_dir(spark, "t"), []
    write_batch(checkout(spark, *TWICE), path, CHECKOUTS, 0, query="q")
    write_batch(checkout(spark, *TWICE), path, CHECKOUTS, 0, query="q")
    write_batch(checkout(spark, ("p1", "c9", at("11:59")), ("p4", "c4", at("11:59"))), path, CHECKOUTS, 1, query="q")
    kept = [("p1", "c1"), ("p2", "c3")]
    assert rows(read_rows(spark, path, CHECKOUTS), "purchase_id", "click_id") == [*kept, ("p4", "c4")]
    monkeypatch.setattr(tables, "read_jdbc", lambda *args, **options: checkout(spark))
    monkeypatch.setattr(DataFrameWriter, "save", lambda writer: sent.append(rows(writer._df, "purchase_id", "click_id")))
    tables.jdbc_store("jdbc:none", "result")(checkout(spark, *TWICE), "checkouts", CHECKOUTS, 0, "q")
    assert sent == [kept]


def test_rows_without_key_all_stay(spark):
    df = counts(spark, ("a", 2, NOON), ("a", 1, NOON), (None, 1, NOON), (None, 1, NOON))
    assert rows(first_per_key(df, SOURCES.key), "source", "count") == [("a", 1), (None, 1), (None, 1)]


def test_text_keys_can_split_a_scan():
    first, second = hash_predicates("user_id", 2, hashed="crc({column})")
    assert first == "MOD(crc(user_id), 2) = 0 OR user_id IS NULL" and second == "MOD(crc(user_id), 2) = 1"


def test_newest_day_and_days_of_a_table(spark):
    path = work_dir(spark, "t")
    days = [NOON + dt.timedelta(days=d) for d in range(3)]
    write_batch(counts(spark, *[("a", i, t) for i, t in enumerate(days)]), path, SOURCES, 0)
    assert stored_days(spark, path) == [d.date() for d in days]
    assert rows(newest_day(spark, path, SOURCES), "count") == [(2,)]
    assert rows(read_since(spark, path, SOURCES, days[2], "1 day"), "count") == [(1,), (2,)]
    assert read_days(spark, path, SOURCES, [dt.date(1999, 1, 1)]) is None


def test_subscription_names_ignore_blanks():
    assert topic_names("clicks, min_clicks ,") == ["clicks", "min_clicks"]
    options = kafka_options("broker:9092", ["a", "b"])
    assert options["subscribe"] == "a,b" and options["failOnDataLoss"] == "false"
    assert kafka_options("broker:9092", "a", failOnDataLoss="true")["failOnDataLoss"] == "true"


def test_topics_can_go_to_kafka(monkeypatch):
    seen = []
    monkeypatch.setattr(topics, "write_kafka_topic", lambda *args: seen.append(args))
    topics.topic_sink(topics.kafka_topics("broker:9092"))("rows", "checkouts", "/cp", None, "update")
    assert seen == [("rows", "broker:9092", "checkouts", "/cp", None, "update")]
    options = topics.kafka_sink_options("broker:9092", "checkouts", "/cp")
    assert options == {"kafka.bootstrap.servers": "broker:9092", "topic": "checkouts", "checkpointLocation": "/cp"}


def test_jdbc_scan_can_be_split():
    options = jdbc_options("jdbc:x", "users", JdbcRange("id", "0", "100", 8), user="u")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8" and options["user"] == "u"
    assert jdbc_options("jdbc:x", "users") == {"url": "jdbc:x", "dbtable": "users"}


def test_work_dir_is_under_the_shared_setting(spark):
    assert work_dir(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_dir(spark, "a") != work_dir(spark, "a")


@pytest.mark.parametrize("contract", [USERS, PRODUCTS, *ROLLUPS.values()])
def test_contract_keys_are_columns(contract):
    assert set(contract.key) <= set(contract.columns)


def test_jdbc_append_sends_only_missing_rows(spark, monkeypatch):
    """The database is replaced by a table in memory; no connection is made."""
    stored, sent = [("a", 1, at("10:00")), ("old", 1, at("01:00"))], []
    monkeypatch.setattr(tables, "read_jdbc", lambda session, url, table, **options: counts(session, *stored))

    def save(writer):
        sent.append(rows(writer._df, "source", "count"))

    monkeypatch.setattr(DataFrameWriter, "save", save)
    store = tables.jdbc_store("jdbc:none", "result", user="u")
    batch = counts(spark, ("a", 1, at("10:00")), ("b", 2, at("11:00")))
    store(batch, "source_count", SOURCES, 7)
    store(batch.where("false"), "source_count", SOURCES, 8)
    assert sent == [[("b", 2)]]


def test_compacted_days_hold_the_same_rows_in_one_folder(spark, monkeypatch):
    path, day = work_dir(spark, "t"), NOON.date()
    for n in range(4):
        write_batch(counts(spark, (f"s{n}", n, NOON), ("x", n, NOON + dt.timedelta(days=1))), path, SOURCES, n, query=f"q{n % 2}")
    want = rows(read_rows(spark, path, SOURCES))
    with monkeypatch.context() as patched:  # a crash right after the move
        patched.setattr(tables, "_delete", lambda *args: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError, match="crash"):
            compact_day(spark, path, SOURCES, day)
    for _ in range(2):
        compact_day(spark, path, SOURCES, day)
        assert rows(read_rows(spark, path, SOURCES)) == want
        there = [q for q in folders(spark, f"{path}/date={day}") if folders(spark, f"{path}/date={day}/{q}")]
        assert there == ["query=compacted"]
    write_batch(counts(spark, ("late", 9, NOON)), path, SOURCES, 9, query="q0")
    compact_day(spark, path, SOURCES, day)
    assert rows(read_rows(spark, path, SOURCES)) == sorted([*want, (9, "late", NOON)], key=repr)
    assert stored_days(spark, path) == [day, day + dt.timedelta(days=1)]


def test_readers_see_each_row_once_while_a_day_is_compacted(spark, monkeypatch):
    path, day = work_dir(spark, "t"), NOON.date()
    for n in range(3):
        write_batch(counts(spark, (f"s{n}", n, NOON), ("x", n, NOON + dt.timedelta(days=1))), path, SOURCES, n)
    want = rows(read_rows(spark, path, SOURCES))
    planned = read_rows(spark, path, SOURCES)
    compact_day(spark, path, SOURCES, day, remove=False)
    assert len(folders(spark, f"{path}/date={day}/query=batch")) == 3  # both copies are there
    assert rows(planned) == want
    assert rows(read_rows(spark, path, SOURCES)) == want
    assert rows(read_days(spark, path, SOURCES, [day]).select(*SOURCES.columns)) == [r for r in want if r[2] == NOON]

    write_batch(counts(spark, ("late", 9, NOON)), path, SOURCES, 9)
    want = sorted([*want, (9, "late", NOON)], key=repr)
    real, calls = sources.compacted_folders, []

    def moved_meanwhile(*args):
        calls.append(args)
        found = real(*args)
        if len(calls) == 1:  # the day is compacted after the first look
            compact_day(spark, path, SOURCES, day)
        return found

    monkeypatch.setattr(sources, "compacted_folders", moved_meanwhile)
    assert rows(read_rows(spark, path, SOURCES)) == want
    assert len(calls) == 4  # looked again
    for _ in range(2):
        compact_day(spark, path, SOURCES, day)
    assert real(spark, path) == []


def test_retention_of_a_compacted_day_revives_no_row(spark):
    path, day = work_dir(spark, "t"), NOON.date()
    for n in range(4):
        write_batch(counts(spark, (f"s{n}", n, NOON + dt.timedelta(hours=n))), path, SOURCES, n)
    compact_day(spark, path, SOURCES, day, remove=False)
    drop_expired(spark, path, SOURCES, as_of=NOON + dt.timedelta(days=7, hours=2), keep="7 days")
    assert {r.source for r in read_rows(spark, path, SOURCES).collect()} == {"s2", "s3"}


def test_a_compacted_day_has_files_by_its_bytes(spark, monkeypatch):
    path, day = work_dir(spark, "t"), NOON.date()
    for n in range(6):
        write_batch(counts(spark, (f"s{n}", n, NOON)), path, SOURCES, n)
    monkeypatch.setattr(tables, "FILE_BYTES", 2_000)
    compact_day(spark, path, SOURCES, day)
    assert len(spark.read.parquet(f"{path}/date={day}").inputFiles()) > 1
    assert read_rows(spark, path, SOURCES).count() == 6
