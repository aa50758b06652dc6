"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters of eight bytes run over the whole document
with a stride of four. The document is covered by overlapping chunks of 128
bytes, one every 64; each filter is max-pooled within each chunk. A small
hidden layer looks at each chunk's maxima (a chunk that repeats itself or holds
junk excites few or other filters than prose), and its outputs' mean and
maximum over the chunks are combined into one probability. Training and scoring
read whole documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm import hashing
from clicktrail.llm.common import in_arrow, pieces, stored

WIDTH, STRIDE = 8, 4
HALF = 64
EMBEDDING, FILTERS, HIDDEN = 8, 24, 16
PAD = 256
#: Labelled documents of each class to learn from, and bytes of each of them at most: of a longer text, pieces all over it.
SAMPLE, SAMPLE_BYTES = 1_500, 32_768
EPOCHS, BATCH, RATE = 6, 16, 0.01
THRESHOLD = 0.3
BLOCK = 1 << 20


def padded(data: np.ndarray) -> np.ndarray:
    """A text's bytes, filled up to whole half chunks with at least one stride of padding."""
    out = np.full(-(-(len(data) + STRIDE) // HALF) * HALF, PAD, np.uint16)
    out[: len(data)] = data
    return out


@dataclass
class Network:
    embedding: np.ndarray
    filters: np.ndarray
    offsets: np.ndarray
    hidden: np.ndarray
    hidden_offsets: np.ndarray
    output: np.ndarray
    constant: float = 0.0

    @staticmethod
    def fresh(seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        return Network(
            rng.normal(0, 0.5, (257, EMBEDDING)).astype(np.float32),
            rng.normal(0, 0.25, (WIDTH * EMBEDDING, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            rng.normal(0, 0.25, (FILTERS, HIDDEN)).astype(np.float32),
            np.zeros(HIDDEN, np.float32),
            rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32),
        )

    def activations(self, symbols: np.ndarray) -> np.ndarray:
        """Filter outputs at every stride; the last place has no full window and is 0."""
        rows = self.embedding[symbols].reshape(-1, STRIDE * EMBEDDING)
        half = STRIDE * EMBEDDING
        out = rows @ self.filters[:half]
        out[:-1] += rows[1:] @ self.filters[half:]
        out += self.offsets
        np.maximum(out, 0, out=out)
        out[-1] = 0
        return out

    def half_maxima(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Maxima of every half chunk of texts one after another; ``ends`` are the texts' last strides."""
        out = self.activations(symbols)
        out[ends] = 0
        return out.reshape(-1, HALF // STRIDE, FILTERS).max(axis=1)

    def long_maxima(self, symbols: np.ndarray) -> np.ndarray:
        """The same for one long text, a block at a time."""
        parts = []
        for a in range(0, len(symbols), BLOCK):
            b = min(a + BLOCK, len(symbols))
            out = self.activations(symbols[a : min(b + STRIDE, len(symbols))])[: (b - a) // STRIDE]
            parts.append(out.reshape(-1, HALF // STRIDE, FILTERS).max(axis=1))
        return np.concatenate(parts)

    def pooled(self, halves: np.ndarray) -> np.ndarray:
        """A text's features out of its half chunks' maxima."""
        chunks = np.maximum(chunk_maxima(halves) @ self.hidden + self.hidden_offsets, 0)
        return np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)])

    def score(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(pooled @ self.output + self.constant, -30, 30)))


def chunk_maxima(halves: np.ndarray) -> np.ndarray:
    """A chunk is two neighbouring halves; a text of one half is one chunk."""
    return halves if len(halves) == 1 else np.maximum(halves[:-1], halves[1:])


class Adam:
    def __init__(self, shapes):
        self.m, self.v, self.t = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0

    def step(self, values, gradients, rate: float) -> None:
        self.t += 1
        for value, g, m, v in zip(values, gradients, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            value -= (rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)).astype(value.dtype)


def _gradients(net: Network, symbols: np.ndarray, label: float):
    """Gradients of the log loss of one text. Through the maxima they reach one window for each filter and chunk."""
    out = net.activations(symbols)
    halves = out.reshape(-1, HALF // STRIDE, FILTERS)
    where = halves.argmax(axis=1) + (np.arange(len(halves)) * (HALF // STRIDE))[:, None]
    maxima = np.take_along_axis(out, where, axis=0)
    if len(halves) > 1:
        second = maxima[1:] > maxima[:-1]
        where = np.where(second, where[1:], where[:-1])
        maxima = np.where(second, maxima[1:], maxima[:-1])
    inner = np.maximum(maxima @ net.hidden + net.hidden_offsets, 0)
    top, each = inner.argmax(axis=0), np.arange(HIDDEN)
    features = np.concatenate([inner.mean(axis=0), inner[top, each]])
    error = float(net.score(features) - label)
    back = np.tile(error * net.output[:HIDDEN] / len(inner), (len(inner), 1))
    back[top, each] += error * net.output[HIDDEN:]
    back *= inner > 0
    flow = (back @ net.hidden.T) * (maxima > 0)
    chunk, kind = np.nonzero(flow)
    g, place = flow[chunk, kind], where[chunk, kind]
    windows = symbols[(place * STRIDE)[:, None] + np.arange(WIDTH)]
    inputs = net.embedding[windows].reshape(len(g), WIDTH * EMBEDDING)
    chosen = np.zeros((FILTERS, len(g)), np.float32)
    chosen[kind, np.arange(len(g))] = g
    d_filters = chosen @ inputs
    reached = (g[:, None] * net.filters.T[kind]).reshape(-1, EMBEDDING)
    cells = windows.ravel().astype(np.int64)[:, None] * EMBEDDING + np.arange(EMBEDDING)
    d_embedding = np.bincount(cells.ravel(), reached.ravel(), net.embedding.size).reshape(net.embedding.shape)
    return d_embedding, d_filters.T, np.bincount(kind, g, FILTERS), maxima.T @ back, back.sum(axis=0), error * features, error


def fit(texts: list[bytes], labels: list[int], seed: int = 0) -> Network:
    """The network after a few passes over the sample in a fixed random order."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    inputs = [padded(np.frombuffer(t, np.uint8)) for t in texts]
    constant = np.zeros(1)
    values = [net.embedding, net.filters, net.offsets, net.hidden, net.hidden_offsets, net.output, constant]
    adam, steps = Adam([v.shape for v in values]), 0
    total = EPOCHS * max(1, -(-len(inputs) // BATCH))
    for _ in range(EPOCHS):
        order = rng.permutation(len(inputs))
        for a in range(0, len(order), BATCH):
            batch = order[a : a + BATCH]
            sums = [np.zeros(v.shape) for v in values]
            for n in batch:
                for total_g, g in zip(sums, _gradients(net, inputs[n], labels[n]), strict=True):
                    total_g += g
            adam.step(values, [g / len(batch) for g in sums], RATE * (1 - 0.9 * steps / total))
            net.constant = float(constant[0])
            steps += 1
    return net


def _pieces_of(most: int):
    def cut(batches):
        for batch in batches:
            texts = pa.array([pieces(t.as_py().encode(), most) for t in batch.column("text")], pa.binary())
            columns = [batch.column(c) for c in ("label", "place", "tk")]
            yield pa.RecordBatch.from_arrays([*columns, texts], names=["label", "place", "tk", "bytes"])

    return cut


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    sample_bytes: int = SAMPLE_BYTES,
) -> Network:
    """A network taught by the labelled documents among the given ones.

    Up to ``sample`` documents of each label, chosen by a hash of their id, are
    learnt from; the constant is then set for the true shares of the labels
    among the documents. Of a text above ``sample_bytes`` pieces that lie
    evenly all over it teach, so many bytes together. Ids with contradicting
    labels, null labels, null texts and labels of absent documents teach
    nothing. If one of the labels is missing, every score is the share of label
    1 (a half without any label).
    """
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("most"))
        .where("label = most and label in (0, 1)")
        .select("id", "label", F.xxhash64(F.lit("quality"), "id").alias("place"))
    )
    ids = documents.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("d_id")).distinct()
    present = stored(known.join(ids, F.col("id") == F.col("d_id")).drop("d_id"), "quality-labels")
    shares = {row["label"]: row["count"] for row in present.groupBy("label").count().collect()}
    net = Network.fresh()
    positive, negative = shares.get(1, 0), shares.get(0, 0)
    if not positive or not negative:
        net.output[:] = 0
        share = 0.5 if not shares else float(bool(positive))
        net.constant = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return net
    first = lambda label: present.where(F.col("label") == label).orderBy("place", "id").limit(sample)
    chosen = F.broadcast(first(0).unionByName(first(1)))
    rows = (
        documents.where(F.col(text_col).isNotNull())
        .select(F.col(id_col).alias("d_id"), F.xxhash64(text_col).alias("tk"), F.col(text_col).cast("string").alias("text"))
        .join(chosen, F.col("d_id") == F.col("id"))
        .select("label", "place", "tk", "text")
    )
    # one text of each id, however many rows repeat it
    rows = in_arrow(rows, _pieces_of(sample_bytes), "label int, place long, tk long, bytes binary")
    rows = rows.groupBy("place", "label").agg(F.min_by("bytes", "tk").alias("bytes")).toPandas().sort_values("place")
    net = fit([bytes(t) for t in rows["bytes"]], rows["label"].tolist())
    seen = rows["label"].mean()
    net.constant += float(np.log(positive / negative) - np.log(seen / (1 - seen)))
    return net


def score_batch(net: Network, texts: pa.Array) -> np.ndarray:
    data, offsets = hashing.text_buffers(texts)
    scores = np.empty(len(texts))
    for i, j in hashing.text_slices(offsets, BLOCK // 2):
        symbols = [padded(data[a:b]) for a, b in zip(offsets[i:j], offsets[i + 1 : j + 1], strict=True)]
        if j == i + 1 and len(symbols[0]) > BLOCK:
            scores[i] = net.score(net.pooled(net.long_maxima(symbols[0])))
            continue
        ends = np.cumsum([len(s) for s in symbols])
        halves = net.half_maxima(np.concatenate(symbols), ends // STRIDE - 1)
        bounds = np.concatenate([[0], ends // HALF])
        scores[i:j] = net.score(np.stack([net.pooled(halves[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]))
    return scores


def score_quality(documents: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc`` (its columns), score (0 to 1, higher for label 1), predicted (1 from the threshold on).

    Only the text is looked at, and all of it. Null and empty texts are scored
    like a text of padding. Repeated rows get equal scores; an empty table
    gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(net)

    def score(batches):
        for batch in batches:
            scores = score_batch(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(scores, pa.float64())], names=["doc", "score"])

    columns = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    rows = documents.select(columns.alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, score double"
    return in_arrow(rows, score, schema).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
