"""A topic into tables, nothing lost: rows in time, late rows and rejected payloads.

Stateful operators drop rows behind the watermark, and the codec makes NULLs of
what does not parse. Here both are kept: each micro-batch is scanned once and
split at the watermark that Spark itself would apply to it, the latest event
time of all earlier micro-batches less the allowed lateness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from clicktrail.functions.codec import accepted, rejected
from clicktrail.functions.temporal import micros
from clicktrail.schemas import TableContract
from clicktrail.sinks.tables import query_id, write_batch
from clicktrail.sources.tables import exists
from clicktrail.streaming.pipeline import BatchWriter, write_tables
from clicktrail.streaming.triggers import Trigger

REJECT_SCHEMA = "value string, reasons array<string>"
NEWEST_SCHEMA = "newest long"


def _own_folder(path: str, query: str, batch_id: int) -> str:
    return f"{path}/query={query}/batch_id={batch_id}"


def _newest_before(spark: SparkSession, path: str, query: str, batch_id: int) -> int | None:
    """Latest event time, in microseconds, of all micro-batches before this one; each stores it for the next."""
    folder = _own_folder(path, query, batch_id - 1)
    if not exists(spark, folder):
        return None
    return spark.read.schema(NEWEST_SCHEMA).parquet(folder).first().newest


def is_late(event_time: str, newest: int | None, lateness: str) -> Column:
    """Whether an event lies behind the watermark that the latest event time so far sets."""
    if newest is None:
        return F.lit(False)
    return F.col(event_time) < F.timestamp_micros(F.lit(newest - micros(lateness)))


def side_output_writer(spark: SparkSession, root: str, name: str, contract: TableContract, lateness: str) -> BatchWriter:
    """Writes checked rows (:func:`clicktrail.functions.codec.check_topic`) to three tables of ``root``.

    ``name`` has the rows in time, ``name_late`` those behind the watermark and
    ``name_rejects`` payloads with the reasons against them. A replayed
    micro-batch replaces its own folders in all of them.
    """
    time = contract.event_time

    def write(checked: DataFrame, batch_id: int) -> None:
        query = query_id(checked)
        before = _newest_before(spark, f"{root}/{name}_progress", query, batch_id)
        checked.persist()
        try:
            rows = accepted(checked)
            late = is_late(time, before, lateness)
            write_batch(rows.where(~late), f"{root}/{name}", contract, batch_id, query=query)
            write_batch(rows.where(late), f"{root}/{name}_late", contract, batch_id, query=query)
            rejected(checked).write.mode("overwrite").parquet(_own_folder(f"{root}/{name}_rejects", query, batch_id))
            newest = rows.agg(F.greatest(F.max(F.unix_micros(time)), F.lit(before).cast("long")).alias("newest"))
            # last: a micro-batch that stops before this is replayed as a whole
            newest.write.mode("overwrite").parquet(_own_folder(f"{root}/{name}_progress", query, batch_id))
        finally:
            checked.unpersist()

    return write


def start_side_outputs(
    checked: DataFrame,
    root: str,
    name: str,
    contract: TableContract,
    checkpoint: str,
    lateness: str = "10 minutes",
    trigger: Trigger = None,
) -> StreamingQuery:
    """Keep the three tables of a topic's checked rows up to date."""
    write = side_output_writer(checked.sparkSession, root, name, contract, lateness)
    return write_tables(checked, write, checkpoint, trigger, f"{name} and side outputs")


def read_rejects(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rejected payloads with their reasons, of all queries and micro-batches."""
    return spark.read.schema(REJECT_SCHEMA).parquet(f"{root}/{name}_rejects").select("value", "reasons")
