"""What a stopped query holds in state, and how to move it to other shards.

The number of state shards is fixed for the life of a checkpoint. To move to
another number, let the query read all there is, stop it and start one with a
new checkpoint and the new ``state_partitions`` on the same topics and store.
Its table sinks compare what they write with what the earlier query has stored
(:func:`clicktrail.streaming.pipeline.start_checkout_table`), so nothing is
stored twice. ``state_operators`` tells the shards of a checkpoint before and
after, ``shard_rows`` whether some hold much more than others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint: operatorId, operatorName, stateStoreName, numPartitions, batch ids."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_of(
    spark: SparkSession, checkpoint: str, operator: int = 0, join_side: str | None = None, batch_id: int | None = None
) -> DataFrame:
    """Rows (key, value, partition_id) of one stateful operator after its last micro-batch, or after ``batch_id``.

    Of a stream-stream join, ``join_side`` ("left" or "right") tells which input's rows.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if join_side is not None:
        reader = reader.option("joinSide", join_side)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def shard_rows(spark: SparkSession, checkpoint: str, operator: int = 0, join_side: str | None = None) -> DataFrame:
    """Rows that each shard of an operator holds: partition_id, rows."""
    return state_of(spark, checkpoint, operator, join_side).groupBy("partition_id").agg(F.count(F.lit(1)).alias("rows"))
