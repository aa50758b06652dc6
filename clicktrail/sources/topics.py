"""Topics: append-only event logs read as streams or as whole tables.

A topic is either a Kafka topic, when the connector is on the class path, or a
directory of Parquet files with a text column ``value``; both give rows of
(topic, value).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VALUE_SCHEMA = "value STRING"


def topic_names(topics: str | Iterable[str]) -> list[str]:
    """Names from a list or a comma-separated subscription; blanks do not count."""
    parts = topics.split(",") if isinstance(topics, str) else topics
    return [name for name in (part.strip() for part in parts) if name]


def topic_dir(root: str, topic: str) -> str:
    return f"{root.rstrip('/')}/{topic}"


def kafka_options(servers: str, topics: str | Iterable[str], **options: str) -> dict[str, str]:
    """Options of one subscription, tolerant of offsets the broker has dropped unless ``failOnDataLoss`` says otherwise."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topic_names(topics)),
        "failOnDataLoss": "false",
        **options,
    }


def read_kafka_topics(spark: SparkSession, servers: str, topics: str | Iterable[str], **options: str) -> DataFrame:
    """Stream of one or several Kafka topics."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **options))
    return reader.load().select("topic", F.col("value").cast("string").alias("value"))


def read_topics(
    spark: SparkSession, root: str, topics: str | Iterable[str], files_per_batch: int | None = None
) -> DataFrame:
    """Stream of one or several topic directories."""

    def one(topic: str) -> DataFrame:
        reader = spark.readStream.schema(VALUE_SCHEMA)
        if files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(topic_dir(root, topic)).select(F.lit(topic).alias("topic"), "value")

    return reduce(DataFrame.unionByName, map(one, topic_names(topics)))


def load_topics(spark: SparkSession, root: str, topics: str | Iterable[str]) -> DataFrame:
    """The messages that topic directories hold now, as a table."""

    def one(topic: str) -> DataFrame:
        rows = spark.read.schema(VALUE_SCHEMA).parquet(topic_dir(root, topic))
        return rows.select(F.lit(topic).alias("topic"), "value")

    return reduce(DataFrame.unionByName, map(one, topic_names(topics)))
