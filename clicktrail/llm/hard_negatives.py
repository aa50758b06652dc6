"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors are ordered by length, label and their place on a Hilbert curve through
the components that vary most, and stored as Parquet rows of up to a thousand
vectors: blocks. A block's zone map has the least and greatest value of each
component. Neighbouring blocks of one label make a strip, neighbouring anchors
a pack.

Interval arithmetic on zone maps bounds every inner product. On boxes (a pack
against a strip) it decides which strips are sent to which packs; inside a
task, on single anchors and blocks, which blocks are scored. Four passes of
that kind:

1. each pack against its own strip: a score that its positives reach at least;
2. all strips of its label that may reach it: the positives;
3. each pack against the strip of another label of the greatest bound: scores
   that the negatives in each positive's window reach at least;
4. all strips of other labels that may hold better ones: the negatives.

The bounds decide what is read, never what is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm.common import in_arrow, stored
from clicktrail.llm.knn import NO_ID, SCALE, SLACK, exact_products

#: Components on the Hilbert curve and bits of each.
CURVE_DIMS, CURVE_BITS = 10, 6
POSITIVES = NEGATIVES = 5
#: Hundredths of the positive's score that a negative reaches at least.
LEAST_SHARE = 80
LOWEST, HIGHEST = -(2**63), 2**63 - 1



@dataclass(frozen=True)
class Layout:
    """Vectors of a block, blocks of a strip, anchors of a pack, and boxes that are compared at once on either side."""

    block: int = 1_024
    strip: int = 64
    pack: int = 512
    boxes: int = 512


BLOCKS = (
    "strip long, block int, dim int, label long, rows binary, ids binary, asks binary, v binary, lo binary, hi binary"
)
PACKS = "pack long, home long, dim int, label long, rows binary, ids binary, v binary, lo binary, hi binary"
ZONES = "strip long, dim int, label long, lo binary, hi binary"
FOUND = "anchor_row long, anchor_id long, key_row long, key_id long, key_score long, row long, id long, score long"


# --- Hilbert order ------------------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (a row of whole numbers below 2**bits) on the Hilbert curve."""
    x = cells.astype(np.int64).T.copy()
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            here = (x[i] & q) != 0
            swap = np.where(here, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(here, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), top
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(turn)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | ((axis >> bit) & 1)
    return key


def _matrix(column: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    """Vectors of one length out of a list column."""
    return column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim).astype(np.int64)


def _keyed_of(spread: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """``spread``: by length, the components on the curve, their means and deviations."""

    def keyed(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            key = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                places, mean, deviation = spread[int(dim)]
                part = (_matrix(batch.column("v"), rows, dim)[:, places] - mean) / (4 * deviation) + 0.5
                cells = np.clip(np.floor(part * (1 << CURVE_BITS)), 0, (1 << CURVE_BITS) - 1)
                key[rows] = hilbert_keys(cells, CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=[*batch.schema.names, "key"])

    return keyed


def labelled_vectors(vectors: DataFrame, is_anchor, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(row, id, dim, label, asks, v) of the rows that take part; components as floor(scale * x)."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    usable = F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite
    return vectors.where(usable).select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.size(vector_col).alias("dim"),
        F.col(label_col).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"),
    )


def _spread(numbered: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    values = numbered.select("dim", F.posexplode("v").alias("place", "x"))
    moments = values.groupBy("dim", "place").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("deviation")).toPandas()
    out = {}
    for dim, part in moments.groupby("dim"):
        part = part.sort_values(["deviation", "place"], ascending=[False, True]).head(CURVE_DIMS)
        out[int(dim)] = part["place"].to_numpy(), part["mean"].to_numpy(), np.maximum(part["deviation"].to_numpy(), 1e-9)
    return out


# --- blocks, strips and packs -----------------------------------------------------------


def _cut(batches, block: int) -> Iterator[tuple[int, int, dict[str, np.ndarray], np.ndarray]]:
    """(dim, label, columns, vectors) of up to a block's vectors each, out of rows sorted by (dim, label, key)."""
    held, kind = [], None

    def joined():
        columns = {c: np.concatenate([h[0][c] for h in held]) for c in ("row", "id", "asks")}
        return *kind, columns, np.concatenate([h[1] for h in held])

    for batch in batches:
        dims, labels = batch.column("dim").to_numpy(), batch.column("label").to_numpy()
        columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "id", "asks")}
        at = 0
        while at < len(dims):
            now = int(dims[at]), int(labels[at])
            if held and kind != now:
                yield joined()
                held = []
            kind = now
            room = block - sum(len(h[1]) for h in held)
            same = (dims[at : at + room] == now[0]) & (labels[at : at + room] == now[1])
            stop = at + (len(same) if same.all() else int(same.argmin()))
            rows = np.arange(at, stop)
            held.append(({c: v[at:stop] for c, v in columns.items()}, _matrix(batch.column("v"), rows, now[0])))
            at = stop
            if stop - rows[0] == room:
                yield joined()
                held = []
    if held:
        yield joined()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _task_number() -> int:
    context = TaskContext.get()
    return (context.partitionId() if context else 0) << 32


def _blocks_of(layout: Layout):
    def blocks(batches):
        rows, strip, block, last = [], _task_number() - 1, 0, None
        for dim, label, columns, v in _cut(batches, layout.block):
            if block == layout.strip or last != (dim, label):
                strip, block, last = strip + 1, 0, (dim, label)
            ids = [columns[c].astype(t).tobytes() for c, t in (("row", np.int64), ("id", np.int64), ("asks", np.bool_))]
            rows.append((strip, block, dim, label, *ids, v.tobytes(), v.min(axis=0).tobytes(), v.max(axis=0).tobytes()))
            block += 1
            if len(rows) == 16:
                yield _batch(rows, BLOCKS)
                rows = []
        yield _batch(rows, BLOCKS)

    return blocks


def _zones(batches):
    """Boxes of strips, one or several of a strip."""
    for batch in batches:
        boxes: dict[tuple, list] = {}
        for r in batch.to_pylist():
            boxes.setdefault((r["strip"], r["dim"], r["label"]), []).append((r["lo"], r["hi"]))
        rows = []
        for key, found in boxes.items():
            lo, hi = (np.stack([np.frombuffer(b, np.int64) for b in side]) for side in zip(*found, strict=True))
            rows.append((*key, lo.min(axis=0).tobytes(), hi.max(axis=0).tobytes()))
        yield _batch(rows, ZONES)


def _packs_of(layout: Layout):
    def packs(batches):
        """Anchors that lie near one another, with their box."""
        number = _task_number()
        for batch in batches:
            near: dict[tuple, list] = {}
            for r in batch.to_pylist():
                asks = np.frombuffer(r["asks"], np.bool_)
                if asks.any():
                    v = np.frombuffer(r["v"], np.int64).reshape(-1, r["dim"])[asks]
                    own = [np.frombuffer(r[c], np.int64)[asks] for c in ("rows", "ids")]
                    near.setdefault((r["strip"], r["dim"], r["label"]), []).append((*own, v))
            rows = []
            for key, parts in near.items():
                row, id_, v = (np.concatenate(c) for c in zip(*parts, strict=True))
                for a in range(0, len(row), layout.pack):
                    part = slice(a, a + layout.pack)
                    box = v[part].min(axis=0).tobytes(), v[part].max(axis=0).tobytes()
                    rows.append((number, *key, row[part].tobytes(), id_[part].tobytes(), v[part].tobytes(), *box))
                    number += 1
            yield _batch(rows, PACKS)

    return packs


# --- which strips a pack must read --------------------------------------------------------


def box_bounds(a_lo, a_hi, b_lo, b_hi) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of any vector in a box of a with any in a box of b, for all pairs of boxes."""
    least, most = (np.zeros((len(a_lo), len(b_lo))) for _ in range(2))
    for d in range(a_lo.shape[1]):
        corners = [np.multiply.outer(x[:, d], y[:, d]) for x in (a_lo, a_hi) for y in (b_lo, b_hi)]
        least += np.minimum.reduce(corners)
        most += np.maximum.reduce(corners)
    return least, most


def point_bounds(a: np.ndarray, b_lo: np.ndarray, b_hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for points a."""
    up, down = np.maximum(a, 0.0), np.minimum(a, 0.0)
    return up @ b_lo.T + down @ b_hi.T, up @ b_hi.T + down @ b_lo.T


def widened(least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds with room for rounding."""
    return least - np.abs(least) * SLACK - 1e-6, most + np.abs(most) * SLACK + 1e-6


def _chosen_of(same: bool, only_best: bool):
    def boxes(column) -> dict:
        found = column.as_py()
        return {
            "of": np.array([b["of"] for b in found]), "dim": np.array([b["dim"] for b in found]), "label": np.array([b["label"] for b in found]),
            "low": np.array([b["low"] for b in found], float), "high": np.array([b["high"] for b in found], float),
            "lo": [b["lo"] for b in found], "hi": [b["hi"] for b in found],
        }

    def matrix(parts, rows) -> np.ndarray:
        return np.stack([np.frombuffer(parts[r], np.int64) for r in rows]).astype(float)

    def chosen(batches):
        for batch in batches:
            for p, z in zip(batch.column("packs"), batch.column("zones"), strict=True):
                packs, zones = boxes(p), boxes(z)
                for dim in np.intersect1d(packs["dim"], zones["dim"]):
                    i, j = np.flatnonzero(packs["dim"] == dim), np.flatnonzero(zones["dim"] == dim)
                    sides = [matrix(side[c], at) for side, at in ((packs, i), (zones, j)) for c in ("lo", "hi")]
                    least, most = widened(*box_bounds(*sides))
                    allowed = (packs["label"][i][:, None] == zones["label"][j][None, :]) == same
                    allowed &= (most >= packs["low"][i][:, None]) & (least <= packs["high"][i][:, None])
                    if only_best:
                        best = np.where(allowed, most, -np.inf).argmax(axis=1)
                        some = allowed.any(axis=1)
                        x, y = np.flatnonzero(some), best[some]
                    else:
                        x, y = np.nonzero(allowed)
                    columns = [packs["of"][i[x]], zones["of"][j[y]], most[x, y]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["pack", "strip", "most"])

    return chosen


def chosen_strips(zones: DataFrame, packs: DataFrame, windows: DataFrame, boxes: int, same: bool, only_best: bool = False) -> DataFrame:
    """(pack, strip): the strips of the pack's label (or of others) whose products may fall into some window of the pack.

    Boxes are compared in pieces of a few hundred on either side; only boxes travel, not vectors.
    """
    reach = windows.groupBy("pack").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    asking = packs.select("pack", "dim", "label", "lo", "hi").join(reach, "pack").withColumnRenamed("pack", "of")
    offered = zones.withColumnRenamed("strip", "of").withColumns({"low": F.lit(0).cast("long"), "high": F.lit(0).cast("long")})
    pieces = [max(1, -(-side.count() // boxes)) for side in (packs, zones)]

    def in_pieces(rows: DataFrame, n: int, others: int, name: str, own: str, other: str) -> DataFrame:
        box = F.struct("of", "dim", "label", "low", "high", "lo", "hi")
        grouped = rows.groupBy(F.pmod(F.xxhash64("of"), F.lit(n)).alias(own)).agg(F.collect_list(box).alias(name))
        return grouped.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))))

    left = in_pieces(asking, pieces[0], pieces[1], "packs", "p", "z")
    right = in_pieces(offered, pieces[1], pieces[0], "zones", "z", "p")
    pairs = in_arrow(left.join(right, ["p", "z"]).select("packs", "zones"), _chosen_of(same, only_best), "pack long, strip long, most double")
    if only_best:
        return pairs.groupBy("pack").agg(F.max_by("strip", F.struct("most", "strip")).alias("strip"))
    return pairs.select("pack", "strip").distinct()


# --- scoring ---------------------------------------------------------------------------------


def first_of(window, score, id_, row, k: int) -> np.ndarray:
    """Places of the first k of each window: greater scores first, then smaller ids, then rows."""
    order = np.lexsort((row, id_, ~score, window))  # ~ turns the order of whole numbers round and cannot overflow
    w = window[order]
    begins = np.flatnonzero(np.append(True, w[1:] != w[:-1])) if len(w) else np.zeros(0, np.int64)
    place = np.arange(len(w)) - np.repeat(begins, np.diff(np.append(begins, len(w))))
    return order[place < k]


class Strip:
    """The blocks of one strip."""

    def __init__(self):
        self.blocks = []

    def add(self, r: dict) -> None:
        v = np.frombuffer(r["v"], np.int64).reshape(-1, r["dim"])
        ends = [np.frombuffer(r[c], np.int64).astype(float) for c in ("lo", "hi")]
        self.blocks.append((np.frombuffer(r["rows"], np.int64), np.frombuffer(r["ids"], np.int64), v, *ends))

    def best(self, anchors: np.ndarray, anchor_rows: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        """(window, score, id, row) of the first k rows in each window [low, high] of the anchors ``of``; never the anchor's own row."""
        least, most = widened(*point_bounds(anchors.astype(float), *(np.stack([b[n] for b in self.blocks]) for n in (3, 4))))
        floor = low.copy()
        kept = tuple(np.zeros(0, np.int64) for _ in range(4))
        for n in np.argsort(-most.max(axis=0), kind="stable"):
            able = np.flatnonzero((most[of, n] >= floor) & (least[of, n] <= high))
            if not len(able):
                continue
            rows, ids, v = self.blocks[n][:3]
            used, at = np.unique(of[able], return_inverse=True)
            products = exact_products(anchors[used], v)[at]
            fits = (products >= floor[able][:, None]) & (products <= high[able][:, None])
            fits &= rows[None, :] != anchor_rows[of[able]][:, None]
            if len(rows) > k and fits.sum() > 4 * k * len(able):
                among = np.where(fits, products, LOWEST)
                fits &= products >= np.partition(among, len(rows) - k, axis=1)[:, len(rows) - k][:, None]
            x, y = np.nonzero(fits)
            found = able[x], products[x, y], ids[y], rows[y]
            kept = tuple(np.concatenate(c) for c in zip(kept, found, strict=True))
            first = first_of(*kept, k)
            kept = tuple(c[first] for c in kept)
            full = np.bincount(kept[0], minlength=len(of)) == k
            worst = np.full(len(of), HIGHEST)
            np.minimum.at(worst, kept[0], kept[1])
            floor = np.where(full, np.maximum(floor, worst), floor)
        return kept


def _scored_of(k: int):
    def scored(batches):
        """Rows come sorted by strip, its blocks before the packs that read it."""
        now, strip = None, Strip()
        for batch in batches:
            for n in range(batch.num_rows):
                r = {c: batch.column(c)[n].as_py() for c in batch.schema.names if c != "windows"}
                if r["strip"] != now:
                    now, strip = r["strip"], Strip()
                if r["kind"] == 0:
                    strip.add(r)
                    continue
                if not strip.blocks:
                    continue
                rows, ids = (np.frombuffer(r[c], np.int64) for c in ("rows", "ids"))
                anchors = np.frombuffer(r["v"], np.int64).reshape(len(rows), -1)
                asked = batch.column("windows")[n].values
                anchor, key_row, key_id, key_score, low, high = (
                    asked.field(c).to_numpy() for c in ("anchor_row", "key_row", "key_id", "key_score", "low", "high")
                )
                by_row = np.argsort(rows)
                of = by_row[np.searchsorted(rows[by_row], anchor)]
                w, score, id_, row = strip.best(anchors, rows, of, low, high, k)
                columns = rows[of[w]], ids[of[w]], key_row[w], key_id[w], key_score[w], row, id_, score
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in FOUND.split(", ")])

    return scored


def best_in_windows(blocks: DataFrame, packs: DataFrame, windows: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The first k rows in each window of the packs' anchors, out of the strips paired with the packs.

    ``windows`` has (pack, anchor_row, key_row, key_id, key_score, low, high). A
    task holds one strip and reads the packs that need it as a stream.
    """
    window = F.struct("anchor_row", "key_row", "key_id", "key_score", "low", "high")
    asked = windows.groupBy("pack").agg(F.collect_list(window).alias("windows"))
    asking = pairs.join(packs.drop("lo", "hi"), "pack").join(asked, "pack")
    needed = blocks.join(pairs.select("strip").distinct(), "strip", "left_semi")
    rows = (
        needed.drop("asks", "label")
        .withColumn("kind", F.lit(0))
        .unionByName(asking.drop("pack", "home", "label").withColumn("kind", F.lit(1)), allowMissingColumns=True)
        .repartition("strip")
        .sortWithinPartitions("strip", "kind", "block")
    )
    best = Window.partitionBy("anchor_row", "key_row").orderBy(F.desc("score"), "id", "row")
    found = in_arrow(rows, _scored_of(k), FOUND).withColumn("rank", F.row_number().over(best))
    return found.where(F.col("rank") <= k)


def _raised(windows: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Windows whose low end is the k-th score found for them, where there are so many."""
    kth = found.where(F.col("rank") == k).select("anchor_row", "key_row", F.col("score").alias("kth"))
    joined = windows.join(kth, ["anchor_row", "key_row"], "left")
    return joined.withColumn("low", F.greatest("low", F.coalesce("kth", "low"))).drop("kth")


def hilbert_blocks(numbered: DataFrame, layout: Layout) -> DataFrame:
    """The stored blocks of (row, id, dim, label, asks, v)."""
    spark = numbered.sparkSession
    keyed = in_arrow(numbered, _keyed_of(_spread(numbered)), "row long, id long, dim int, label long, asks boolean, v array<long>, key long")
    count = numbered.count()
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(-(-count // (layout.block * layout.strip)), min(width, -(-count // layout.block)), 1)
    order = ["dim", "label", "key", "row"]
    return stored(in_arrow(keyed.repartitionByRange(tasks, *order).sortWithinPartitions(*order), _blocks_of(layout), BLOCKS), "hilbert-blocks")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_share: int = LEAST_SHARE,
    scale: int = SCALE,
    layout: Layout = Layout(),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), ranks from 1.

    Scores are integer inner products; greater ones come first, ties by smaller
    id, a null id last, then by row. An anchor's positives are its first rows of
    the same label; a positive's negatives the first rows of other labels whose
    score is at least ``least_share`` hundredths of the positive's and at most
    the positive's. A positive of a score below 0 has none. Labels are whole
    numbers. Rows with null labels, vectors that are null, empty or hold null or
    non-finite components take no part; vectors of different lengths are not
    compared; a product beyond 64 bits becomes the nearest 64-bit number. Rows
    that repeat an id are rows of their own; only an anchor's own row is never
    its positive. Other columns are not looked at. An empty table gives no rows.
    """
    numbered = stored(labelled_vectors(vectors, is_anchor, id_col, vector_col, label_col, scale), "negatives-vectors")
    blocks = hilbert_blocks(numbered, layout)
    zones = stored(in_arrow(blocks.select("strip", "dim", "label", "lo", "hi"), _zones, ZONES), "negatives-zones")
    packs = stored(in_arrow(blocks.drop("block", "lo", "hi"), _packs_of(layout), PACKS), "negatives-packs")

    # every anchor has one window without limits for its positives; null keys would not join
    none = F.lit(0).cast("long")
    unlimited = numbered.where("asks").select(F.col("row").alias("anchor_row"), none.alias("key_row"), none.alias("key_id"), none.alias("key_score"))
    members = stored(in_arrow(packs.select("pack", "rows"), _members, "pack long, anchor_row long"), "negatives-anchors")
    anywhere = unlimited.join(members, "anchor_row").withColumns({"low": F.lit(LOWEST), "high": F.lit(HIGHEST)})
    at_home = best_in_windows(blocks, packs, anywhere, packs.select("pack", F.col("home").alias("strip")), positives)
    reached = stored(_raised(anywhere, at_home, positives), "negatives-reached")
    first = best_in_windows(blocks, packs, reached, chosen_strips(zones, packs, reached, layout.boxes, same=True), positives)
    chosen = stored(first.select("anchor_row", F.col("row").alias("key_row"), F.col("id").alias("key_id"), F.col("score").alias("key_score")), "positives")

    score = F.col("key_score")
    windows = (
        chosen.where(score >= 0)  # below 0 no score is between a share of it and itself
        .withColumns({"low": F.ceil(score.cast("decimal(20,0)") * least_share / F.lit(100)).cast("long"), "high": score})
        .join(members, "anchor_row")
    )
    windows = stored(windows, "negatives-windows")
    sample = best_in_windows(blocks, packs, windows, chosen_strips(zones, packs, windows, layout.boxes, same=False, only_best=True), negatives)
    raised = stored(_raised(windows, sample, negatives), "negatives-raised")
    found = best_in_windows(blocks, packs, raised, chosen_strips(zones, packs, raised, layout.boxes, same=False), negatives)
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return found.select(
        F.col("anchor_id"),
        known("key_id").alias("positive_id"),
        "rank",
        known("id").alias("negative_id"),
        F.col("key_score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def _members(batches):
    for batch in batches:
        rows = [np.frombuffer(r, np.int64) for r in batch.column("rows").to_pylist()]
        packs = np.repeat(batch.column("pack").to_numpy(), [len(r) for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array(packs), pa.array(np.concatenate(rows) if rows else packs)], names=["pack", "anchor_row"])
