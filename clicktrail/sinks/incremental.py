"""Roll-ups of a checkout table, kept up to date as batches are added to it.

Each refresh looks at the batch folders that no earlier refresh has seen, finds
the windows that their rows fall into, and computes those windows anew from the
days they lie in. The new values are a newer version of their rows in the cube;
:func:`clicktrail.streaming.pipeline.provisional_rollup` reads the latest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.functions.temporal import bucket_start
from clicktrail.operators.rollups import WINDOW, rollup_cube
from clicktrail.schemas import CUBE, TableContract
from clicktrail.sinks.tables import write_batch
from clicktrail.sources.tables import exists, folders, read_days

#: Writer of refreshed rows.
REFRESH = "refresh"


def batch_folders(spark: SparkSession, path: str) -> set[str]:
    """The batch folders of a stored table, as ``date=.../query=.../batch_id=...``."""
    days = [day for day in folders(spark, path) if day.startswith("date=")]
    queries = [f"{day}/{query}" for day in days for query in folders(spark, f"{path}/{day}")]
    return {f"{query}/{batch}" for query in queries for batch in folders(spark, f"{path}/{query}")}


def touched_rows(
    spark: SparkSession, path: str, contract: TableContract, new: list[str], window: str
) -> DataFrame | None:
    """All stored rows of the windows that rows in the given batch folders fall into; only the days of those windows are read."""
    time = contract.event_time
    start = bucket_start(time, window)
    added = spark.read.schema(contract.schema).parquet(*[f"{path}/{name}" for name in new]).where(F.col(time).isNotNull())
    windows = added.select(start.alias("_start")).distinct()
    last = F.window(F.col(time), window)["end"] - F.expr("INTERVAL 1 MICROSECOND")
    reach = F.sequence(F.to_date(start), F.to_date(last))
    # one row for each day that windows touch
    days = [row.day for row in added.select(F.explode(reach).alias("day")).distinct().collect()]
    stored = read_days(spark, path, contract, days)
    if stored is None:
        return None
    return stored.withColumn("_start", start).join(windows, "_start", "left_semi").select(*contract.columns)


def refresh_cube(
    spark: SparkSession, path: str, contract: TableContract, root: str, window: str = WINDOW
) -> list[str]:
    """Bring the roll-up cube under ``root`` up to the checkout table at ``path``; returns the batch folders that were new.

    Only one refresh of a cube may run at a time. One that fails half-way is
    repeated by the next: what it had seen is noted after its rows are written.
    """
    notes = f"{root}/seen"
    earlier = sorted(int(name.removeprefix("refresh=")) for name in folders(spark, notes))
    noted = [f"{notes}/refresh={n}" for n in earlier if exists(spark, f"{notes}/refresh={n}/_SUCCESS")]
    seen = {row.value for row in spark.read.text(noted).collect()} if noted else set()
    new = sorted(batch_folders(spark, path) - seen)
    if not new:
        return []
    number = len(noted)
    rows = touched_rows(spark, path, contract, new, window)
    if rows is not None:
        write_batch(rollup_cube(rows, window), f"{root}/cube", CUBE if _zoned(contract) else CUBE.zoneless(), number, query=REFRESH)
    spark.createDataFrame([(name,) for name in new], "value string").coalesce(1).write.mode("overwrite").text(f"{notes}/refresh={number}")
    return new


def _zoned(contract: TableContract) -> bool:
    return contract.schema[contract.event_time].dataType.simpleString() == "timestamp"
