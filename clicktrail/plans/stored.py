"""Tables that several queries share, written once per session to the work folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clicktrail.operators.rollups import rollup_cube, rollup_from_cube
from clicktrail.plans.testdata_views import data_version
from clicktrail.schemas import ROLLUPS
from clicktrail.session import work_dir
from clicktrail.sinks.tables import write_batch
from clicktrail.sources.tables import read_rows

_done: dict[tuple, str] = {}


def once(spark: SparkSession, sf_dir: str, *key: str, make: Callable[[], str]) -> str:
    """The folder that ``make`` filled the first time this session asked for it, while the data stays as it is."""
    full = (spark.sparkContext.applicationId, sf_dir, data_version(spark, sf_dir), *key)
    if full not in _done:
        _done[full] = make()
    return _done[full]


def stored_cube(spark: SparkSession, checkouts: DataFrame, sf_dir: str) -> DataFrame:
    """The roll-up cube of some checkouts as a table, so that the checkouts are computed once."""

    def make() -> str:
        path = work_dir(spark, "cube")
        rollup_cube(checkouts).write.parquet(path)
        return path

    return spark.read.parquet(once(spark, sf_dir, "cube", make=make))


def stored_checkouts(spark: SparkSession, checkouts: DataFrame, sf_dir: str) -> DataFrame:
    """Some checkouts as a table with exact amounts, computed once."""

    def make() -> str:
        path = work_dir(spark, "exact-checkouts")
        checkouts.write.parquet(path)
        return path

    return spark.read.parquet(once(spark, sf_dir, "exact-checkouts", make=make))


def write_rollup(spark: SparkSession, cube: DataFrame, table: str) -> str:
    """A fresh roll-up table out of a cube, partitioned by day; returns its path."""
    path = work_dir(spark, table)
    write_batch(rollup_from_cube(cube, table), path, ROLLUPS[table].zoneless(), batch_id=0, gather_days=True)
    return path


def read_rollup(spark: SparkSession, path: str, table: str) -> DataFrame:
    return read_rows(spark, path, ROLLUPS[table].zoneless())
