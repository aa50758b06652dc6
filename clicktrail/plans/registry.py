"""Named queries over the generated tables, one or more per operator.

Attribution queries run at the ten-minute lookback and, with suffix ``_1d``,
at one day, where the generated events have many more matches. Roll-ups,
reports and retention use one day. Reports and retention work on stored
roll-up tables and take the newest row as "now".
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktrail.functions.codec import (
    accepted,
    check_clicks,
    decode_clicks,
    decode_purchases,
    decode_rows,
    encode_rows,
    rejected,
    topic_values,
)
from clicktrail.operators import attribution, reports
from clicktrail.operators.contracts import conform, key_violations
from clicktrail.operators.enrich import enrich_purchases
from clicktrail.operators.rollups import rollup, rollup_cube, rollup_from_cube, with_status
from clicktrail.operators.skew import hot_keys
from clicktrail.plans import testdata_views as views
from clicktrail.plans.checkouts import trailing_checkouts, windowed_checkouts
from clicktrail.plans.stored import once, read_rollup, stored_checkouts, stored_cube, write_rollup
from clicktrail.plans.streams import (
    checkouts_of_hot_keys,
    checkouts_table,
    faulty_messages,
    final_clicks_topic,
    min_clicks_topic,
    open_windows,
    provisional_tables,
    rollup_tables,
    side_outputs,
    staged_topics,
    topic_rollup_tables,
    trailing_table,
)
from clicktrail.schemas import CHECKOUTS, CLICKS, CUBE, PRODUCTS, ROLLUPS, USERS, TableContract
from clicktrail.session import work_dir
from clicktrail.sinks.incremental import refresh_cube
from clicktrail.sinks.tables import drop_expired, load_dimension, read_dimension, write_batch
from clicktrail.sources.tables import CSV_OPTIONS, newest_day, read_csv_table, read_rows, read_since
from clicktrail.sources.topics import read_topics
from clicktrail.streaming.pipeline import provisional_rollup
from clicktrail.streaming.side_outputs import read_rejects
from clicktrail.streaming.triggers import AVAILABLE_NOW

Query = Callable[[SparkSession, str], DataFrame]

TEN_MINUTES, DAY = "10 minutes", "1 day"
REPORT_HORIZON = "7 days"
#: Of the disordered replay.
LATENESS = "1 day"
KEEP = "2 days"


def at_edge(df: DataFrame) -> DataFrame:
    """Decimals as doubles and zone-less timestamps, for comparison with another engine."""

    def edge(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return df.select([edge(field) for field in df.schema])


# --- sources and codec -------------------------------------------------------


def stream_topic_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subscription to both topics, counted per topic by a streaming aggregate."""
    out = work_dir(spark, "topic-scan")
    counts = read_topics(spark, staged_topics(spark, sf_dir), "clicks, purchases").groupBy("topic").count()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/counts")

    query = (
        counts.writeStream.foreachBatch(write)
        .outputMode("complete")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/counts").select("topic", F.col("count").alias("messages"))


def demux_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_values(views.topic_events(spark, sf_dir), "clicks")


def parse_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_clicks(views.topic_events(spark, sf_dir), time_type="timestamp_ntz")


def typed_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_edge(decode_purchases(views.topic_events(spark, sf_dir), time_type="timestamp_ntz"))


def scan_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_edge(views.products(spark, sf_dir))


def dimension_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.products(spark, sf_dir).select("product_id")


def csv_roundtrip_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "products-csv")
    views.products(spark, sf_dir).write.options(**CSV_OPTIONS).csv(path)
    return at_edge(read_csv_table(spark, path, PRODUCTS))


def _loaded(spark: SparkSession, rows: DataFrame, contract: TableContract) -> DataFrame:
    """CSV seed, dimension table, read back."""
    seed, table = work_dir(spark, "seed-csv"), work_dir(spark, "dimension")
    rows.write.options(**CSV_OPTIONS).csv(seed)
    load_dimension(read_csv_table(spark, seed, contract), table, contract)
    return at_edge(read_dimension(spark, table, contract))


def load_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, views.users(spark, sf_dir), USERS)


def load_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, views.products(spark, sf_dir), PRODUCTS)


def table_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "checkouts")
    _stored(trailing(spark, sf_dir, DAY)).write.parquet(path)
    return spark.read.parquet(path)


def json_encode_checkouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkouts as topic messages, decoded again."""
    messages = encode_rows(trailing(spark, sf_dir, DAY)).withColumn("topic", F.lit("checkouts"))
    return at_edge(decode_rows(messages, "checkouts", CHECKOUTS.schema))


# --- enrichment and attribution ------------------------------------------------


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_edge(
        enrich_purchases(
            views.purchases(spark, sf_dir), views.users(spark, sf_dir), views.products(spark, sf_dir)
        )
    )


def _entities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return tuple(view(spark, sf_dir) for view in (views.clicks, views.purchases, views.users, views.products))


def windowed(spark: SparkSession, sf_dir: str, lookback: str) -> DataFrame:
    return windowed_checkouts(*_entities(spark, sf_dir), lookback)


def trailing(spark: SparkSession, sf_dir: str, lookback: str) -> DataFrame:
    return trailing_checkouts(*_entities(spark, sf_dir), lookback)


def _stored(checkouts: DataFrame) -> DataFrame:
    return conform(checkouts, CHECKOUTS.zoneless())


def conform_checkouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(windowed(spark, sf_dir, DAY))


def key_violations_checkouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_violations(conform_checkouts(spark, sf_dir), CHECKOUTS.key)


def checkouts(spark: SparkSession, sf_dir: str, lookback: str) -> DataFrame:
    return _stored(windowed(spark, sf_dir, lookback))


def first_click_attribution(spark: SparkSession, sf_dir: str, lookback: str) -> DataFrame:
    return _stored(trailing(spark, sf_dir, lookback))


def checkouts_with_status(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    return _stored(with_status(trailing(spark, sf_dir, DAY), status))


def click_query(spark: SparkSession, sf_dir: str, operator, lookback: str) -> DataFrame:
    return operator(views.clicks(spark, sf_dir), lookback)


# --- roll-ups, reports, retention ----------------------------------------------


def rolled_up(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    contract = ROLLUPS[table].zoneless()
    return at_edge(conform(rollup(trailing(spark, sf_dir, DAY), table), contract))


def single_pass(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    cube = rollup_cube(trailing(spark, sf_dir, DAY))
    return at_edge(conform(rollup_from_cube(cube, table), ROLLUPS[table].zoneless()))


def stored_rollup(spark: SparkSession, sf_dir: str, table: str) -> str:
    """Path of a roll-up table as the reports find it; attribution runs once for all five."""

    def make() -> str:
        return write_rollup(spark, _cube(spark, sf_dir), table)

    return once(spark, sf_dir, "rollup", table, make=make)


def _cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_cube(spark, trailing(spark, sf_dir, DAY), sf_dir)


def retained(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A stored roll-up table after expired days and rows were removed from it."""
    path = write_rollup(spark, _cube(spark, sf_dir), table)
    newest = newest_day(spark, path, ROLLUPS[table].zoneless()).agg(F.max("time").cast("string")).first()[0]
    as_of = F.lit(newest).cast("timestamp_ntz")
    drop_expired(spark, path, ROLLUPS[table].zoneless(), as_of, KEEP)
    return at_edge(read_rollup(spark, path, table))


def report_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_edge(reports.report_revenue(read_rollup(spark, stored_rollup(spark, sf_dir, "revenue"), "revenue")))


def count_report(spark: SparkSession, sf_dir: str, report, table: str) -> DataFrame:
    """A report over the days its horizon can touch; the newest day tells what "now" is."""
    path, contract = stored_rollup(spark, sf_dir, table), ROLLUPS[table].zoneless()
    as_of = reports.latest(newest_day(spark, path, contract))
    return report(read_since(spark, path, contract, as_of, REPORT_HORIZON), as_of, REPORT_HORIZON)


# --- streams ---------------------------------------------------------------------


def stream_min_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_edge(min_clicks_topic(spark, sf_dir, TEN_MINUTES, AVAILABLE_NOW))


def stream_topic_rollup(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return at_edge(topic_rollup_tables(spark, sf_dir, DAY, AVAILABLE_NOW)[table])


def stream_final_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_edge(final_clicks_topic(spark, sf_dir, TEN_MINUTES, AVAILABLE_NOW))


def stream_checkouts_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_edge(checkouts_table(spark, sf_dir, DAY, AVAILABLE_NOW))


def hot_keys_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and products that at least one purchase in a hundred has."""
    purchases = views.purchases(spark, sf_dir)
    return hot_keys(purchases, "user_id").unionByName(hot_keys(purchases, "product_id"))


def stream_hot_key_checkouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streamed attribution join with only its hot users and products salted."""
    return at_edge(checkouts_of_hot_keys(spark, sf_dir, DAY, AVAILABLE_NOW))


def stream_first_click_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_edge(trailing_table(spark, sf_dir, DAY, AVAILABLE_NOW))


def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty click messages with what is wrong with them."""
    checked = check_clicks(faulty_messages(views.clicks(spark, sf_dir)))
    return rejected(checked).select("value", F.array_join("reasons", "; ").alias("reasons"))


def parse_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other click messages, typed by the same parse."""
    return accepted(check_clicks(faulty_messages(views.clicks(spark, sf_dir)), time_type=T.TimestampNTZType()))


def stream_late_events(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return at_edge(read_rows(spark, f"{side_outputs(spark, sf_dir, LATENESS, AVAILABLE_NOW)}/{table}", CLICKS))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = read_rejects(spark, side_outputs(spark, sf_dir, LATENESS, AVAILABLE_NOW), "clicks")
    return rejects.select("value", F.array_join("reasons", "; ").alias("reasons"))


def incremental_rollup(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Roll-ups after three additions to the checkout table: earlier purchases, later ones, and stragglers of all times."""
    contract = CHECKOUTS.zoneless()

    def make() -> str:
        path, root = work_dir(spark, "checkouts"), work_dir(spark, "incremental")
        checkouts = stored_checkouts(spark, trailing(spark, sf_dir, DAY), sf_dir)
        middle = checkouts.select(F.percentile_approx(F.unix_micros(F.col("purchase_time").cast("timestamp")), 0.5)).first()[0]
        straggles = F.col("purchase_id").cast("long") % 10 == 0
        late = F.unix_micros(F.col("purchase_time").cast("timestamp")) > F.lit(middle or 0)
        for n, part in enumerate((~straggles & ~late, ~straggles & late, straggles)):
            write_batch(checkouts.where(part), path, replace(contract, first_by=()), n)
            refresh_cube(spark, path, contract, root)
        return root

    root = once(spark, sf_dir, "incremental", make=make)
    latest = provisional_rollup(spark, f"{root}/cube", table, contract=CUBE.zoneless())
    return at_edge(conform(latest, ROLLUPS[table].zoneless()))


def stream_state_after_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_edge(open_windows(spark, sf_dir, TEN_MINUTES, AVAILABLE_NOW))


def stream_update_rollup(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    latest = provisional_tables(spark, sf_dir, DAY, AVAILABLE_NOW)[table]
    return at_edge(conform(latest, ROLLUPS[table]))


def stream_rollup(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return at_edge(rollup_tables(spark, sf_dir, DAY, AVAILABLE_NOW)[table])


def all_queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "stream_topic_scan": stream_topic_scan,
        "demux_topic": demux_topic,
        "parse_clicks": parse_clicks,
        "parse_rejects": parse_rejects,
        "parse_accepted": parse_accepted,
        "typed_purchases": typed_purchases,
        "scan_users": views.users,
        "scan_products": scan_products,
        "csv_roundtrip_products": csv_roundtrip_products,
        "dimension_ids": dimension_ids,
        "load_users": load_users,
        "load_products": load_products,
        "table_readback": table_readback,
        "json_encode_checkouts": json_encode_checkouts,
        "conform_checkouts": conform_checkouts,
        "key_violations_checkouts": key_violations_checkouts,
        "enrich_purchases": enriched,
        "successful_checkouts": partial(checkouts_with_status, status="success"),
        "failed_checkouts": partial(checkouts_with_status, status="failure"),
        "stream_min_click": stream_min_click,
        "stream_final_clicks": stream_final_clicks,
        "stream_state_after_flush": stream_state_after_flush,
        "stream_on_time_events": partial(stream_late_events, table="clicks"),
        "stream_late_events": partial(stream_late_events, table="clicks_late"),
        "stream_rejects": stream_rejects,
        "hot_keys_purchases": hot_keys_purchases,
        "stream_checkouts_sink": stream_checkouts_sink,
        "stream_hot_key_checkouts": stream_hot_key_checkouts,
        "stream_first_click_attribution": stream_first_click_attribution,
    }
    for suffix, lookback in (("", TEN_MINUTES), ("_1d", DAY)):
        named |= {
            f"min_click{suffix}": partial(click_query, operator=attribution.min_click, lookback=lookback),
            f"final_clicks{suffix}": partial(click_query, operator=attribution.final_clicks, lookback=lookback),
            f"final_clicks_second_join{suffix}": partial(
                click_query, operator=attribution.final_clicks_second_join, lookback=lookback
            ),
            f"checkouts{suffix}": partial(checkouts, lookback=lookback),
            f"first_click_attribution{suffix}": partial(first_click_attribution, lookback=lookback),
        }
    for table in ROLLUPS:
        named |= {
            table: partial(rolled_up, table=table),
            f"{table}_single_pass": partial(single_pass, table=table),
            f"incremental_{table}": partial(incremental_rollup, table=table),
            f"stream_{table}": partial(stream_rollup, table=table),
            f"stream_topic_{table}": partial(stream_topic_rollup, table=table),
            f"stream_update_{table}": partial(stream_update_rollup, table=table),
            f"retention_{table}": partial(retained, table=table),
        }
    return named | {
        "report_revenue": report_revenue,
        "report_sources": partial(count_report, report=reports.report_sources, table="source_count"),
        "report_top_categories": partial(
            count_report, report=reports.report_top_categories, table="category_count"
        ),
        "report_gender": partial(count_report, report=reports.report_gender, table="gender_count"),
        "report_failures": partial(count_report, report=reports.report_failures, table="fail_count"),
    }
