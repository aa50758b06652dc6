"""Topic sinks: every row one JSON message."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from clicktrail.functions.codec import encode_rows
from clicktrail.sinks.tables import query_id
from clicktrail.sources.topics import topic_dir
from clicktrail.streaming.triggers import Trigger, with_trigger


#: Publishes a stream on a topic: (rows, topic, checkpoint, trigger, output mode).
TopicSink = Callable[[DataFrame, str, str, Trigger, str], StreamingQuery]


def write_topic(
    rows: DataFrame, root: str, topic: str, checkpoint: str, trigger: Trigger = None, mode: str = "append"
) -> StreamingQuery:
    """Send a stream to a topic directory.

    In append mode each row arrives exactly once. In update mode a row may
    come again with a newer value, and each micro-batch is a folder of its own
    that a replay replaces.
    """
    messages = encode_rows(rows)
    if mode == "append":
        writer = messages.writeStream.format("parquet").option("path", topic_dir(root, topic))
    else:

        def store(batch: DataFrame, batch_id: int) -> None:
            named = batch.select("value", F.lit(query_id(batch)).alias("query"), F.lit(batch_id).alias("batch_id"))
            (
                named.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("query", "batch_id")
                .parquet(topic_dir(root, topic))
            )

        writer = messages.writeStream.foreachBatch(store)
    writer = writer.outputMode(mode).queryName(f"topic {topic} {checkpoint}").option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()


def write_kafka_topic(
    rows: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    trigger: Trigger = None,
    mode: str = "append",
) -> StreamingQuery:
    """Send a stream to a Kafka topic, at least once."""
    writer = (
        encode_rows(rows)
        .writeStream.format("kafka")
        .outputMode(mode)
        .queryName(f"topic {topic} {checkpoint}")
        .options(**kafka_sink_options(servers, topic, checkpoint))
    )
    return with_trigger(writer, trigger).start()


def kafka_sink_options(servers: str, topic: str, checkpoint: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}


def directory_topics(root: str) -> TopicSink:
    """Topics as directories of ``root``."""
    return lambda rows, topic, checkpoint, trigger, mode: write_topic(rows, root, topic, checkpoint, trigger, mode)


def kafka_topics(servers: str) -> TopicSink:
    """Topics of a Kafka cluster."""
    return lambda rows, topic, checkpoint, trigger, mode: write_kafka_topic(
        rows, servers, topic, checkpoint, trigger, mode
    )


def topic_sink(topics: TopicSink | str) -> TopicSink:
    """A sink as it is, a text as the root of topic directories."""
    return directory_topics(topics) if isinstance(topics, str) else topics


def append_topic(messages: DataFrame, root: str, topic: str) -> None:
    """Append a table of messages to a topic directory."""
    messages.select("value").write.mode("append").parquet(topic_dir(root, topic))
