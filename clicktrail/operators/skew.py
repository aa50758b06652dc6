"""Hot keys: found by a sketch, counted exactly, and spread over several tasks while all other keys stay whole.

Batch joins leave skew to adaptive execution. A streamed join has no run-time
sizes, so there the hot keys are looked up beforehand and only their rows are
salted: the rows of the large side go to one of several tasks each, the matching
rows of the other side to all of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tasks for every key, or by key column and value (as text) for hot values only.
Salts = int | Mapping[str, Mapping[str, int]]

#: A value is hot if at least one row in so many has it; no more values than this can be hot.
ONE_IN = 100


def hot_keys(rows: DataFrame, key: str, one_in: int = ONE_IN) -> DataFrame:
    """Values (as text) that at least one in ``one_in`` rows has: key, value, rows, all_rows; rows with a NULL key do not count.

    A sketch names candidates in one aggregate with map-side combine, then only
    their rows are counted. The sketch is wrong by less than a tenth of a hot
    value's rows, so with twice as many candidates as there can be hot values
    none is missed, and the exact counts drop the rest. The candidates are
    broadcast: there are at most ``2 * one_in`` of them.
    """
    values = rows.select(F.col(key).cast("string").alias("value")).where("value IS NOT NULL")
    top = F.expr(f"approx_top_k(value, {2 * one_in}, {max(10_000, 50 * one_in)})")
    candidates = values.agg(F.count(F.lit(1)).alias("all_rows"), top.alias("top")).select(
        "all_rows", F.explode("top.item").alias("value")
    )
    return (
        values.join(F.broadcast(candidates), "value")
        .groupBy("value", "all_rows")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") * one_in >= F.col("all_rows"))
        .select(F.lit(key).alias("key"), "value", "rows", "all_rows")
    )


def salts_for(rows: DataFrame, keys: Sequence[str], tasks: int, one_in: int = ONE_IN) -> DataFrame:
    """Hot values with their number of tasks: the value's share of ``tasks``, two at least."""
    share = F.ceil(F.col("rows") * F.lit(tasks) / F.col("all_rows"))
    found = [hot_keys(rows, key, one_in) for key in keys]
    hot = found[0]
    for more in found[1:]:
        hot = hot.unionByName(more)
    return hot.select("key", "value", F.greatest(F.lit(2), share).cast("int").alias("tasks"))


def as_salts(found: DataFrame) -> Salts:
    """The rows of :func:`salts_for`, at most ``one_in`` for each key, as a setting of joins."""
    salts: dict[str, dict[str, int]] = {}
    for key, value, tasks in found.select("key", "value", "tasks").collect():
        salts.setdefault(key, {})[value] = tasks
    return salts


def tasks_of(salts: Salts, key: str, column: str | None = None) -> Column | None:
    """Number of tasks of each row's key, which ``column`` holds if not ``key``; None if no key has more than one."""
    if isinstance(salts, int):
        return F.lit(salts) if salts > 1 else None
    hot = salts.get(key)
    if not hot:
        return None
    value = F.col(column or key).cast("string")
    table = F.create_map(*[F.lit(part) for item in hot.items() for part in item])
    return F.when(value.isin(*hot), F.element_at(table, value)).otherwise(F.lit(1))


def salted(rows: DataFrame, tasks: Column, by: str) -> DataFrame:
    """Rows with the task ``_salt`` of their key's tasks that they go to."""
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), tasks).cast("int"))


def copied(rows: DataFrame, tasks: Column, name: str = "_salt") -> DataFrame:
    """Rows once for each task of their key."""
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), tasks - 1)))
