"""Exact top-k search by inner product: a Voronoi kNN join.

Vectors are grouped by their nearest pivot, and by their distance to it in
rings. Per cell and ring, counts and greatest distances are the summary. Every
query knows a score it reaches at least, its k-th best among the pivots (which
are data vectors). From summaries and the smallest such score of a query
group, the plan tells which rings may hold a better vector for that group; only
those are sent to it. Each block of vectors is scored against a query group
locally, queries that the block cannot improve being left out, and the best of
all blocks are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm.common import in_pandas, stored

#: Pivots of a dimension are the square root of the rows, within these bounds; more rows make larger cells.
FEWEST_PIVOTS, MOST_PIVOTS = 64, 4_096
RINGS = 4
#: Vectors that are compared with the pivots at a time.
STEP = 1_024
#: Vectors in a block and queries in a group.
BLOCK, GROUP = 2_048, 512
TOP = 5
SCALE = 256

CELLS = (
    "row long, vec_id long, dim int, v binary, is_query boolean, cell int, distance double, norm double, reach double"
)
SCORES = "query_row long, query_id long, row long, vec_id long, score long"
#: Bounds are computed in doubles; this relative slack covers their rounding.
SLACK = 1e-9


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(row, vec_id, dim, v): components as floor(scale * x). Vectors null, empty or with null or non-finite components are left out."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return (
        vectors.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("vec_id"),
            F.size(vector_col).alias("dim"),
            F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"),
        )
    )


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point where every sum is exact in it, else in 64-bit or in long integers.

    A product beyond 64 bits becomes the nearest 64-bit number.
    """
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    limits = np.iinfo(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, limits.min, limits.max).astype(np.int64)


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int64).reshape(len(column), dim)


def _cells_of(pivots: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """``pivots``: per dimension, the pivots' rows and vectors."""

    def slices(batch):
        for dim, part in batch.groupby("dim"):
            for first in range(0, len(part), STEP):
                yield dim, part.iloc[first : first + STEP]

    def cells(batches):
        for batch in batches:
            for dim, part in slices(batch):
                v = np.stack([np.asarray(x, np.int64) for x in part["v"]])
                rows, centres = pivots[dim]
                scores = exact_products(v, centres)
                norms = np.sqrt((v.astype(float) ** 2).sum(axis=1))
                squares = (centres.astype(float) ** 2).sum(axis=1)
                cell = (squares[None, :] - 2.0 * scores).argmin(axis=1)
                distance = np.sqrt(((v.astype(float) - centres[cell]) ** 2).sum(axis=1))
                # its own row does not count among what a pivot reaches
                known = np.where(part["row"].to_numpy()[:, None] == rows[None, :], -np.inf, scores.astype(float))
                reach = np.full(len(v), -np.inf)
                if known.shape[1] >= k:
                    reach = -np.partition(-known, k - 1, axis=1)[:, k - 1]
                yield pd.DataFrame(
                    {
                        "row": part["row"], "vec_id": part["vec_id"], "dim": part["dim"], "v": [x.tobytes() for x in v],
                        "is_query": part["is_query"], "cell": cell, "distance": distance, "norm": norms, "reach": reach,
                    }
                )

    return cells


PLAN = "dim int, group int, cell int, ring int"


def _plan_of(pivots, rings: pd.DataFrame):
    """For rows (dim, group, cell, radius, reach) the rings with a vector that may score as high as some of these queries needs.

    For a query q in cell i (radius R) and a vector x of cell j at distance at
    most d from its pivot: q.x <= pi.pj + |pi| d + R |pj| + R d.
    """

    def plan(batches):
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                centres = pivots[dim][1].astype(float)
                norms = np.sqrt((centres**2).sum(axis=1))
                mine = rings[rings["dim"] == dim]
                j, d, ring = (mine[c].to_numpy() for c in ("cell", "far", "ring"))
                for r in part.itertuples(index=False):
                    products = centres @ centres[r.cell]
                    most = products[j] + norms[r.cell] * d + r.radius * norms[j] + r.radius * d
                    needed = most * (1 + SLACK * np.sign(most)) + 1e-6 >= r.reach
                    found = pd.DataFrame({"cell": j[needed], "ring": ring[needed]}).assign(dim=dim, group=r.group)
                    yield found[["dim", "group", "cell", "ring"]]

    return plan


def _scores_of(k: int):
    def best_of(rows, ids, scores, k):
        order = np.lexsort((rows, ids, -scores))[:k]
        return rows[order], ids[order], scores[order]

    def scores(batches):
        kept: dict[int, list] = {}
        for batch in batches:
            for r in batch.itertuples(index=False):
                queries, block = _matrix(r.q_v, r.dim), _matrix(r.v, r.dim)
                centre = np.frombuffer(r.centre, np.int64).astype(float)
                norms = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
                most = queries.astype(float) @ centre + norms * r.far
                able = np.flatnonzero(most * (1 + SLACK * np.sign(most)) + 1e-6 >= np.asarray(r.q_reach))
                if not len(able):
                    continue
                products = exact_products(queries[able], block)
                rows, ids = np.asarray(r.rows), np.asarray(r.ids)
                for n, q in enumerate(able):
                    own = rows != r.q_rows[q]
                    s = products[n][own]
                    if len(s) > k:
                        floor = -np.partition(-s, k - 1)[k - 1]
                        near = s >= floor
                        found = best_of(rows[own][near], ids[own][near], s[near], k)
                    else:
                        found = best_of(rows[own], ids[own], s, k)
                    key = int(r.q_rows[q])
                    if key in kept:
                        found = best_of(*(np.concatenate(c) for c in zip(kept[key][1], found, strict=True)), k)
                    kept[key] = [r.q_ids[q], found]
            if len(kept) > 20_000:
                yield frame(kept)
                kept = {}
        yield frame(kept)

    def frame(kept):
        out = [(q, i, r, v, s) for q, (i, found) in kept.items() for r, v, s in zip(*found, strict=True)]
        return pd.DataFrame(out, columns=["query_row", "query_id", "row", "vec_id", "score"]).astype("int64")

    return scores


#: Stands for a null id among the candidates: it sorts after all others.
NO_ID = 2**63 - 1


def top_k(
    vectors: DataFrame, is_query, k: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int | None = None
) -> DataFrame:
    """Each query's k best other rows by integer inner product: query_id, rank (from 1), vec_id, score.

    ``is_query`` is a condition on the column ``vec_id``. Ties go to the smaller
    vec_id, null ids last. A query with fewer candidates gets them all. Only
    vectors of the same length are compared. Rows that repeat an id are rows
    of their own, as queries (each gets its ranks) and as candidates; a query
    only never finds its own row. Vectors with null or non-finite components
    take no part; an empty table gives no rows.
    """
    numbered = stored(
        integer_vectors(vectors, id_col, vector_col).withColumn("is_query", F.coalesce(is_query, F.lit(False))), "knn-vectors"
    )
    pivots = pivots or min(MOST_PIVOTS, max(FEWEST_PIVOTS, math.isqrt(numbered.count())))
    centres = _pivots(numbered, pivots)
    cells = stored(in_pandas(numbered, _cells_of(centres, k), CELLS), "knn-cells")

    radius = cells.groupBy("dim", "cell").agg(F.max("distance").alias("radius"))
    ring = F.when(F.col("radius") > 0, F.least(F.floor(F.col("distance") / F.col("radius") * RINGS), F.lit(RINGS - 1))).otherwise(0)
    ringed = cells.join(F.broadcast(radius), ["dim", "cell"]).withColumn("ring", ring.cast("int"))
    rings = ringed.groupBy("dim", "cell", "ring").agg(F.count(F.lit(1)).alias("count"), F.max("distance").alias("far"))
    rings_here = rings.toPandas()

    # query groups: neighbouring cells together, as many queries as a group holds; a larger cell is split by hash
    asked = cells.where("is_query")
    sizes = asked.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("queries")).toPandas()
    group_rows = _grouped(centres, sizes)
    spark = vectors.sparkSession
    if not len(group_rows):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    group_table = F.broadcast(spark.createDataFrame(group_rows, "dim int, cell int, first int, parts int"))
    grouped = asked.join(group_table, ["dim", "cell"]).withColumn(
        "group", F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    )
    needs = grouped.groupBy("dim", "group", "cell").agg(F.max("distance").alias("radius"), F.min("reach").alias("reach"))
    plan = stored(in_pandas(needs, _plan_of(centres, rings_here), PLAN).distinct(), "knn-plan")
    packs = grouped.groupBy("dim", "group").agg(
        F.collect_list("row").alias("q_rows"), F.collect_list("vec_id").alias("q_ids"),
        F.collect_list("v").alias("q_v"), F.collect_list("reach").alias("q_reach"),
    )

    table = [
        (int(d), int(c), int(r), int(-(-n // BLOCK)), float(far), centres[d][1][c].tobytes())
        for d, c, r, n, far in rings_here[["dim", "cell", "ring", "count", "far"]].itertuples(index=False)
    ]
    ring_table = F.broadcast(spark.createDataFrame(table, "dim int, cell int, ring int, splits int, far double, centre binary"))
    blocks = (
        ringed.join(ring_table, ["dim", "cell", "ring"])
        .groupBy("dim", "cell", "ring", "far", "centre", F.pmod(F.xxhash64("row"), F.col("splits")).alias("split"))
        .agg(
            F.collect_list("row").alias("rows"),
            F.collect_list(F.coalesce("vec_id", F.lit(NO_ID))).alias("ids"),
            F.collect_list("v").alias("v"),
        )
    )
    # a group's blocks are spread over several tasks, each with a copy of the group's queries
    spread = max(1, -(-int(rings_here["count"].sum()) // (16 * BLOCK)))
    salt = F.pmod(F.xxhash64("cell", "ring", "split"), F.lit(spread)).alias("salt")
    sent = blocks.join(plan, ["dim", "cell", "ring"]).withColumn("salt", salt)
    splits = F.sequence(F.lit(0).cast("long"), F.col("splits").cast("long") - 1)
    wanted = (
        plan.join(ring_table, ["dim", "cell", "ring"])
        .withColumn("split", F.explode(splits))
        .select("dim", "group", salt)
        .distinct()
    )
    asking = packs.join(wanted, ["dim", "group"])
    met = sent.join(asking, ["dim", "group", "salt"]).select(
        "dim", "rows", "ids", "v", "far", "centre", "q_rows", "q_ids", "q_v", "q_reach"
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        in_pandas(met, _scores_of(k), SCORES)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score")
    )


def _pivots(numbered: DataFrame, pivots: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per dimension the rows and vectors of pivots, those of the smallest hashes."""
    by_hash = Window.partitionBy("dim").orderBy(F.xxhash64(F.lit("pivot"), "row"))
    first = numbered.select("dim", "row", F.row_number().over(by_hash).alias("place")).where(F.col("place") <= pivots)
    chosen = numbered.join(first.select("row"), "row").select("dim", "row", "v").orderBy("row").toPandas()
    return {
        int(dim): (part["row"].to_numpy(), np.array(part["v"].tolist(), np.int64).reshape(len(part), dim))
        for dim, part in chosen.groupby("dim")
    }


def _grouped(centres, sizes: pd.DataFrame) -> list[tuple[int, int, int, int]]:
    """(dim, cell, first group, parts): cells in the order of their pivots along one direction, packed into groups."""
    out, group = [], 0
    for dim, part in sizes.groupby("dim"):
        vectors = centres[dim][1].astype(float)
        line = vectors @ (vectors[0] if len(vectors) else 0)
        held = 0
        for cell, n in sorted(zip(part["cell"], part["queries"], strict=True), key=lambda x: -line[x[0]]):
            if held and held + n > GROUP:
                group, held = group + 1, 0
            parts = -(-int(n) // GROUP)
            out.append((int(dim), int(cell), group, parts))
            if parts > 1:
                group, held = group + parts, 0
            else:
                held += int(n)
        group += 1
    return out
