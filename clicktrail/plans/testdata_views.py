"""The engine's entities derived from the generated test tables.

Integer and decimal arithmetic only, so any SQL engine can repeat it. ``k`` is
the integer inside ``events.props``.
"""

from __future__ import annotations

from functools import wraps
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.schemas import CLICK_WIRE, PURCHASE_WIRE
from clicktrail.sources.tables import fingerprint

# What the events stand for, in alphabetical order where the order is free.
SOURCES = ("Facebook", "Gmail", "Google", "Tiktok", "Twitter", "Unknown", "Youtube")
PAYMENT_METHODS = ("Visa", "MasterCard", "Stripe", "Payment on Delivery", "Paypal", "Alipay", "Skrill")
FAILURE_REASONS = (
    "Insufficient Fund",
    "Invalid Payment Details",
    "Network Connectivity Issues",
    "Payment Gateway Issues",
    "Incorrect Billing Address",
    "Card Expired",
)
NO_FAILURE = "none"


TABLES = ("nation", "customer", "part", "events")


def data_version(spark: SparkSession, sf_dir: str) -> tuple:
    """What the files of the tables in use look like now."""
    return tuple(fingerprint(spark, f"{sf_dir}/{name}.parquet") for name in TABLES)


def once_per_session(view):
    """Build a view's plan once for as long as the tables' files stay as they are."""
    built: WeakKeyDictionary[SparkSession, dict] = WeakKeyDictionary()

    @wraps(view)
    def cached(spark: SparkSession, sf_dir: str) -> DataFrame:
        plans, key = built.setdefault(spark, {}), (sf_dir, data_version(spark, sf_dir))
        if key not in plans:
            plans[key] = view(spark, sf_dir)
        return plans[key]

    return cached


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


@once_per_session
def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("event_type = 'click'")
    event = F.col("event_id")
    return rows.select(
        event.alias("click_id"),
        "user_id",
        F.col("ts").alias("click_time"),
        F.when(event % 2 == 0, "Homepage").otherwise("Product").alias("click_at"),
        _pick(SOURCES, _k() % len(SOURCES)).alias("source"),
        F.concat_ws(".", F.lit("10"), F.lit("0"), event % 256, _k()).alias("ip"),
    )


@once_per_session
def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    event = F.col("event_id")
    failed = event % 9 == 4
    reason = _pick(FAILURE_REASONS, F.floor(event / 9) % len(FAILURE_REASONS))
    return rows.select(
        event.alias("purchase_id"),
        "user_id",
        _k().alias("product_id"),
        (event % 31).cast("decimal(10,2)").alias("shipping_cost"),
        ((event % 5) * F.lit("0.08").cast("decimal(3,2)")).cast("decimal(4,2)").alias("discount"),
        F.col("value").alias("total_cost"),
        _pick(PAYMENT_METHODS, event % len(PAYMENT_METHODS)).alias("payment_method"),
        (1 + event % 13).alias("quantity"),
        F.when(failed, "failure").otherwise("success").alias("payment_status"),
        F.when(failed, reason).otherwise(NO_FAILURE).alias("description"),
        F.col("ts").alias("purchase_time"),
    )


@once_per_session
def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
        F.date_add(F.lit("1970-01-01").cast("date"), (key % 10000).cast("int")).alias("birth_day"),
        F.col("n_name").alias("location"),
        F.concat(F.lit("000"), key).alias("phone"),
        F.date_add(F.lit("2020-01-01").cast("date"), (key % 1000).cast("int")).alias("registration_date"),
    )


@once_per_session
def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        ((1 + F.col("p_size") % 10) * F.lit("0.01").cast("decimal(2,2)"))
        .cast("decimal(4,2)")
        .alias("commission_rate"),
    )


def _text(fields: tuple[str, ...]) -> Column:
    """A row as producers send it: one JSON object of strings, mixed-case names."""
    texts = []
    for field in fields:
        text = F.col(field.lower()).cast("string")
        if field.endswith("_time"):
            text = F.translate(text, " ", "T")
        texts.append(text.alias(field))
    return F.to_json(F.struct(*texts))


def click_text() -> Column:
    return _text(CLICK_WIRE)


def _message(rows: DataFrame, topic: str, fields: tuple[str, ...]) -> DataFrame:
    return rows.select(F.lit(topic).alias("topic"), _text(fields).alias("value"))


def click_messages(rows: DataFrame) -> DataFrame:
    return _message(rows, "clicks", CLICK_WIRE)


def purchase_messages(rows: DataFrame) -> DataFrame:
    return _message(rows, "purchases", PURCHASE_WIRE)


def topic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both producer topics as one scan of (topic, value) rows."""
    return click_messages(clicks(spark, sf_dir)).unionByName(purchase_messages(purchases(spark, sf_dir)))
