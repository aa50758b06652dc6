"""Result-table contracts: layout, types and keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.schemas import TableContract


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Columns of the contract in its order and types; a misfit value becomes NULL."""
    return df.select([F.col(field.name).try_cast(field.dataType).alias(field.name) for field in contract.schema])


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or have a NULL part, with their row count."""
    has_null = " OR ".join(f"`{name}` IS NULL" for name in key)
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where(f"rows > 1 OR {has_null}")


def first_per_key(df: DataFrame, key: Sequence[str], first_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, the first by ``first_by`` and then by all columns; rows with a NULL key all stay."""
    rest = [name for name in df.columns if name not in (*key, *first_by)]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*first_by, *rest))
    complete = F.lit(True)
    for name in key:
        complete = complete & F.col(name).isNotNull()
    return df.withColumn("_place", place).where((F.col("_place") == 1) | ~complete).drop("_place")


def settled_first_rows(rows: DataFrame, key: Sequence[str], event_time: str, first_by: Sequence[str]) -> DataFrame:
    """One row per key and event time of a watermarked stream, the first by ``first_by``, once no other can follow.

    An aggregate, so a key costs one row of state, however often it comes. Rows
    with a NULL key are told apart by their content and come out as often as
    they came in.
    """
    names = rows.columns
    complete = F.lit(True)
    for name in key:
        complete = complete & F.col(name).isNotNull()
    rest = [name for name in names if name not in (*key, event_time, *first_by)]
    content = F.when(~complete, F.sha2(F.to_json(F.struct(*names)), 256))
    firsts = (
        rows.withColumn("_content", content)
        .groupBy(*key, event_time, "_content")
        .agg(F.min(F.struct(*first_by, *rest)).alias("_first"), F.count(F.lit(1)).alias("_copies"))
    )
    copies = F.when(F.col("_content").isNull(), F.lit(1)).otherwise(F.col("_copies")).cast("int")
    repeated = firsts.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return repeated.select([F.col(n) if n in key or n == event_time else F.col(f"_first.`{n}`").alias(n) for n in names])


def latest_versions(changes: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """The row of the greatest version of each key; NULLs in a key are values like others."""
    values = [name for name in changes.columns if name not in (*key, version)]
    latest = changes.groupBy(*key).agg(F.max(version).alias(version), F.max_by(F.struct(*values), version).alias("_latest"))
    return latest.select(*key, version, *[F.col(f"_latest.`{name}`").alias(name) for name in values])


def new_rows(batch: DataFrame, stored: DataFrame, key: Iterable[str], first_by: Sequence[str] = ()) -> DataFrame:
    """Rows of a batch whose key the table lacks, one row per key."""
    key = list(key)
    return first_per_key(batch, key, first_by).join(stored.select(*key), key, "left_anti")
