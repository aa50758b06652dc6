"""Table sinks that may be replayed, dimension loads and physical retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.functions.temporal import AsOf, instant, interval
from clicktrail.operators.contracts import conform, first_per_key, new_rows
from clicktrail.operators.retention import KEEP, retain
from clicktrail.schemas import TableContract
from clicktrail.sources.tables import (
    COMPACTED,
    SOURCES,
    STORAGE_COLUMNS,
    compacted_folders,
    exists,
    file_bytes,
    file_system,
    folders,
    jdbc_options,
    read_days,
    read_jdbc,
    read_table,
    replaced_batches,
    stored_days,
)


#: Writer of rows that no streaming query wrote.
BATCH = "batch"


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query whose micro-batch this is; it lives as long as the query's checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or BATCH


def write_batch(
    rows: DataFrame,
    path: str,
    contract: TableContract,
    batch_id: int,
    gather_days: bool = False,
    query: str = BATCH,
) -> None:
    """One micro-batch into a Parquet table partitioned by day, query and batch.

    Replaying a batch overwrites the partitions of that batch and nothing
    else, so a restart neither repeats nor loses rows. A query with a new
    checkpoint counts its batches from 0 again but has another id, so it never
    overwrites what an earlier one stored. ``gather_days`` writes one file per
    day, for tables whose rows per day are bounded, such as roll-ups.

    A table whose contract says which row of a key comes first keeps that one
    of a batch, and nothing of a key it holds already.
    """
    conformed = conform(rows, contract)
    alone = contract.settled and writers(rows.sparkSession, path) <= {query}
    if alone or not contract.first_by:
        _write_partitions(conformed, path, contract, batch_id, gather_days, query)
        return
    conformed.persist()  # its days are looked up first
    try:
        _write_partitions(_unheld(conformed, path, contract, batch_id, query), path, contract, batch_id, gather_days, query)
    finally:
        conformed.unpersist()


def _write_partitions(
    rows: DataFrame, path: str, contract: TableContract, batch_id: int, gather_days: bool, query: str
) -> None:
    stored = rows.withColumns(
        {
            "date": F.to_date(contract.event_time),
            "query": F.lit(query),
            "batch_id": F.lit(batch_id).cast("bigint"),
        }
    )
    if gather_days:
        stored = stored.repartition("date")
    (
        stored.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*STORAGE_COLUMNS)
        .parquet(path)
    )


def writers(spark: SparkSession, path: str) -> set[str]:
    """The queries that have stored rows in a table, by the names of its folders."""
    days = [day for day in folders(spark, path) if day.startswith("date=")]
    return {name.removeprefix("query=") for day in days for name in folders(spark, f"{path}/{day}")}


def _unheld(rows: DataFrame, path: str, contract: TableContract, batch_id: int, query: str) -> DataFrame:
    """First rows of their keys that no other batch has stored; a key's rows share their event time and so their day."""
    spark = rows.sparkSession
    days = [day for (day,) in rows.select(F.to_date(contract.event_time)).distinct().collect() if day is not None]
    held = read_days(spark, path, contract, days)
    if held is None:
        return first_per_key(rows, contract.key, contract.first_by)
    elsewhere = F.col("query") != query
    others = held.where(elsewhere if contract.settled else elsewhere | (F.col("batch_id") != batch_id))
    return new_rows(rows, others, contract.key, contract.first_by)


def load_dimension(rows: DataFrame, path: str, contract: TableContract) -> str:
    """Store a new version of a dimension table and return its folder.

    Earlier versions stay as they are: a query that reads one goes on. Readers
    look for the newest whole version (:func:`read_dimension`).
    """
    versions = _versions(rows.sparkSession, path)
    folder = f"{path}/version={max(versions, default=0) + 1}"
    conform(rows, contract).write.mode("overwrite").parquet(folder)
    return folder


def read_dimension(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """The newest version of a dimension table as of now."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no whole version of a dimension under {path}")
    return spark.read.schema(contract.schema).parquet(f"{path}/version={max(versions)}")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest versions of a dimension, once no query reads them any more."""
    for version in sorted(_versions(spark, path))[: -keep or None]:
        _delete(spark, f"{path}/version={version}")


def _versions(spark: SparkSession, path: str) -> list[int]:
    found = []
    for name in folders(spark, path):
        number = name.removeprefix("version=")
        if name.startswith("version=") and number.isdigit() and exists(spark, f"{path}/{name}/_SUCCESS"):
            found.append(int(number))
    return found


def time_span(rows: DataFrame, time: str) -> tuple[Column, Column] | None:
    """First and last instant of some rows as literals, or None without rows.

    The two values travel as microseconds, so no time zone touches them.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    first, last = rows.agg(F.min(micros), F.max(micros)).first()
    return None if first is None else (F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last)))


def append_jdbc(rows: DataFrame, url: str, table: str, contract: TableContract, **options: str) -> None:
    """Append the rows a database table lacks.

    The stored keys are read only for the batch's own time range. A replay
    after a crash, whole or half-way, finds its earlier rows and adds the rest.
    """
    batch = conform(rows, contract).persist()
    try:
        span = time_span(batch, contract.event_time)
        if span is None:
            return
        stored = read_jdbc(rows.sparkSession, url, table, **options)
        stored = stored.where(F.col(contract.event_time).between(*span))
        missing = new_rows(batch, stored, contract.key, contract.first_by)
        missing.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode("append").save()
    finally:
        batch.unpersist()


#: Stores the rows of one micro-batch of a query in the table of a given name.
Store = Callable[[DataFrame, str, TableContract, int, str], None]


def parquet_store(root: str, gather_days: bool = False) -> Store:
    """Parquet tables in folders of ``root`` named after the table."""

    def store(rows: DataFrame, table: str, contract: TableContract, batch_id: int, query: str = BATCH) -> None:
        write_batch(rows, f"{root}/{table}", contract, batch_id, gather_days, query)

    return store


def jdbc_store(url: str, schema: str, **options: str) -> Store:
    """Tables of a database schema."""

    def store(rows: DataFrame, table: str, contract: TableContract, batch_id: int, query: str = BATCH) -> None:
        append_jdbc(rows, url, f"{schema}.{table}", contract, **options)

    return store


def drop_expired(
    spark: SparkSession, path: str, contract: TableContract, as_of: AsOf, keep: str = KEEP
) -> None:
    """Remove rows older than ``keep`` before ``as_of`` from a stored table.

    Days that lie wholly before the cut-off go as directories, without being
    read. Only the day of the cut-off is rewritten, batch by batch, and its
    batches that have nothing left are dropped, as are folders that compaction has
    replaced. Every step can be repeated.
    """
    cut_off = instant(as_of) - interval(keep)
    cut_day = spark.range(1).select(F.to_date(cut_off)).first()[0]
    for name in replaced_batches(spark, compacted_folders(spark, path, [cut_day])).get(cut_day.isoformat(), ()):
        _delete(spark, f"{path}/date={cut_day.isoformat()}/{name}")
    for day in stored_days(spark, path):
        if day < cut_day:
            _delete(spark, f"{path}/date={day.isoformat()}")

    boundary = read_table(spark, path, contract).where(F.col("date") == F.lit(cut_day))
    newest = boundary.groupBy("query", "batch_id").agg(F.max(contract.event_time).alias("newest"))
    # One row per micro-batch of a single day.
    emptied = newest.where(F.col("newest") < cut_off).select("query", "batch_id").collect()
    (
        retain(boundary, as_of, keep)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*STORAGE_COLUMNS)
        .parquet(path)
    )
    for query, batch_id in emptied:
        _delete(spark, f"{path}/date={cut_day.isoformat()}/query={query}/batch_id={batch_id}")


#: Bytes of the batch folders that go into one file of a compacted day.
FILE_BYTES = 128 << 20


def compact_day(spark: SparkSession, path: str, contract: TableContract, day: dt.date, remove: bool = True) -> None:
    """Gather the batches of a closed day into one folder with few files.

    A day is closed when no query can write to it or replay a batch of it any
    more. The rows are written aside, moved into the table with the list of
    the folders they come from, and then those folders go. Whatever step a
    crash interrupts, calling it again finishes the job.

    The move is what readers see: before it they read the batch folders, after
    it the compacted one, and never both (:func:`read_table`, :func:`read_days`).
    A query that was planned before and still runs fails when its files go; with
    ``remove=False`` they stay until the day is compacted again. Only then does
    the list go, too, once nothing of it is left.
    """
    folder = f"{path}/date={day.isoformat()}"
    done = f"{folder}/query={COMPACTED}"
    lists = compacted_folders(spark, path, [day])
    replaced = replaced_batches(spark, lists).get(day.isoformat(), set())
    batches = {
        f"{query}/{batch}" for query in folders(spark, folder) for batch in folders(spark, f"{folder}/{query}")
    }
    for name in sorted(replaced & batches):
        _delete(spark, f"{folder}/{name}")
    for compacted in lists:
        # one that is itself replaced has gone
        if compacted.split("/")[-1] in folders(spark, done):
            _delete(spark, f"{compacted}/{SOURCES}")
    left = sorted(batches - replaced)
    if len(left) < 2:
        return
    taken = [int(b.removeprefix("batch_id=")) for b in folders(spark, done)]
    aside = f"{path}/_compacting/{day.isoformat()}"
    rows = spark.read.schema(contract.schema).parquet(*[f"{folder}/{name}" for name in left])
    files = 1 + sum(file_bytes(spark, f"{folder}/{name}") for name in left) // FILE_BYTES
    rows.coalesce(files).write.mode("overwrite").parquet(aside)
    spark.createDataFrame([(name,) for name in left], "value string").coalesce(1).write.text(f"{aside}/{SOURCES}")
    source, fs = file_system(spark, aside)
    target, _ = file_system(spark, f"{done}/batch_id={max(taken, default=-1) + 1}")
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{aside} could not be moved to {target}")
    if remove:
        for name in left:
            _delete(spark, f"{folder}/{name}")


def _delete(spark: SparkSession, path: str) -> None:
    location, fs = file_system(spark, path)
    fs.delete(location, True)
