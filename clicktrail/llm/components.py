"""Connected components of an edge list, by contraction.

Each round, every node moves to the smallest label among itself and its
neighbours; nodes of one label become one node and edges inside it vanish.
Nodes and edges shrink by a factor each round, and every step is a
pre-aggregated group-by or an equi-join on tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that has an edge (a, b); the component is one of its nodes.

    Labels are compared by a hash, so that no numbering of the nodes can make
    long chains. Self loops and repeated edges are harmless.
    """
    rounds: list[DataFrame] = []
    left = stored(edges.select("a", "b").where("a != b").distinct(), "component-edges")
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(rounds)), c).alias("h"), F.col(c).alias("node"))  # noqa: E731, B023
        best = F.least(F.min(rank("b")), F.min(rank("a")))["node"]
        moved = stored(both.groupBy("a").agg(best.alias("to")).withColumnRenamed("a", "node"), "component-labels")
        rounds.append(moved)
        to_a = moved.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        to_b = moved.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        left = stored(
            left.join(to_a, "a")
            .join(to_b, "b")
            .where("ta != tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .distinct(),
            "component-edges",
        )
    if not rounds:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    found = rounds[0].select("node", F.col("to").alias("component"))
    for moved in rounds[1:]:
        step = moved.select(F.col("node").alias("component"), "to")
        found = found.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return found
