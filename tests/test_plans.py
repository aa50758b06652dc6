"""Physical plans: what must reach the scan and what must never appear."""

import pytest
from pyspark.sql import functions as F

from clicktrail.operators.attribution import first_click_per_window, interval_attribution, trailing_first_click
from clicktrail.operators.rollups import rollup_cube
from clicktrail.plans import registry, streams
from clicktrail.plans import testdata_views as views
from clicktrail.plans.checkouts import windowed_checkouts

SF_DIR = "/root/testdata/sf0.001"
EAGER = ("stream_", "report_", "retention_", "load_", "csv_", "table_")
QUERIES = registry.all_queries()
LAZY = [name for name in QUERIES if not name.startswith(EAGER)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_small_tables(spark):
    """Plans as for tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert node not in text


def test_event_filters_reach_the_scan(spark):
    text = plan(views.clicks(spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in text


def test_status_filter_reaches_a_stored_table(spark, tmp_path):
    path = str(tmp_path / "t")
    QUERIES["checkouts_1d"](spark, SF_DIR).write.parquet(path)
    stored = spark.read.parquet(path)
    one = stored.where(F.col("payment_status") == "success").groupBy("source").count()
    text = plan(one)
    assert "EqualTo(payment_status,success)" in text
    assert "ReadSchema: struct<payment_status:string,source:string>" in text


def test_large_dimensions_are_not_broadcast(spark, no_small_tables):
    entities = [v(spark, SF_DIR) for v in (views.clicks, views.purchases, views.users, views.products)]
    text = plan(windowed_checkouts(*entities))
    assert "Broadcast" not in text and "SortMergeJoin" in text


@pytest.mark.parametrize("lookback", ["10 minutes", "1 day"])
def test_trailing_reads_events_twice_and_broadcasts_nothing(spark, no_small_tables, lookback):
    """Points are scanned, shuffled and sorted once; only the purchases come again, for their own columns."""
    df = trailing_first_click(views.purchases(spark, SF_DIR), views.clicks(spark, SF_DIR), lookback)
    df.collect()
    text = plan(df)
    final = text.split("== Initial Plan ==")[0]
    assert "Broadcast" not in text
    scans = [line for line in final.splitlines() if "FileScan" in line]
    assert sum("EqualTo(event_type,click)" in line for line in scans) == 1
    assert sum("EqualTo(event_type,purchase)" in line for line in scans) == 2
    assert "ReusedExchange" in final


def test_reports_prune_days(spark):
    query = QUERIES["report_sources"](spark, SF_DIR)
    query.collect()
    scans = [line for line in plan(query).splitlines() if "FileScan" in line]
    assert scans and any("PartitionFilters: [isnotnull(date" in line for line in scans)


def test_interval_join_is_an_equi_join_on_user_and_bucket(spark, no_small_tables):
    firsts = first_click_per_window(views.clicks(spark, SF_DIR))
    text = plan(interval_attribution(views.purchases(spark, SF_DIR), firsts))
    (join,) = [line for line in text.splitlines() if "SortMergeJoin" in line]
    assert "_bucket" in join and "user_id" in join


def test_cube_shuffles_checkouts_once_after_combining(spark, no_small_tables, tmp_path):
    path = str(tmp_path / "t")
    QUERIES["checkouts_1d"](spark, SF_DIR).write.parquet(path)
    text = plan(rollup_cube(spark.read.parquet(path)))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text


def test_a_replay_gets_files_and_shards_by_its_size(spark, monkeypatch):
    """A larger table is read by more tasks and kept in more shards, in as many micro-batches."""
    key = "spark.sql.shuffle.partitions"
    before, sizes = spark.conf.get(key), (1 << 20, 50 << 20, 300 << 20)
    spark.conf.set(key, "200")
    try:
        got = []
        for size in sizes:
            monkeypatch.setattr(streams, "event_bytes", lambda spark, sf_dir, size=size: size)
            files, each = streams.topic_files(spark, SF_DIR), streams.files_per_batch(spark, SF_DIR)
            assert files == each * streams.MICRO_BATCHES
            got.append((each, streams.state_shards(spark, SF_DIR)))
    finally:
        spark.conf.set(key, before)
    assert got == [(1, 4), (3, 7), (15, 38)]
