"""Language identification.

Character n-grams (1 to 3 code points of the lower-cased text, anything but
letters made one space) are hashed to a fixed number of features and weighted
by TF-IDF. A sparse multinomial logistic regression is trained on them with
follow-the-regularised-leader (FTRL-proximal, L1 and L2 penalties) and
calibrated by a temperature. Document frequencies come from all training
documents; the regression is fitted on a bounded sample of them.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.common import in_arrow, pieces

FEATURES = 1 << 16
ORDERS = (1, 2, 3)
#: Documents the regression is fitted on, shared evenly by the languages, and bytes of each at most: of a longer text,
#: pieces all over it.
SAMPLE, SAMPLE_BYTES = 4_000, 100_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
UNDETERMINED = "und"
PIECE = 1 << 20


@functools.cache
def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


def _piece_counts(points: np.ndarray) -> np.ndarray:
    points = np.where(_letters()[points], points, np.uint32(32))
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    points = points[keep]
    counts = np.zeros(FEATURES, np.int64)
    h = np.zeros(len(points), np.uint32)
    for order in ORDERS:
        if len(points) < order:
            break
        h = h[: len(points) - order + 1] * np.uint32(0x01000193) + points[order - 1 :] + np.uint32(1)
        mixed = h * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x85EBCA77)
        counts += np.bincount(mixed >> np.uint32(16), minlength=FEATURES)
    return counts


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of a whole text and their counts; none if it has no letter. Long texts are read in overlapping pieces."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    if not _letters()[points].any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(points) <= PIECE:
        counts = _piece_counts(points)
    else:
        step, lap = PIECE, max(ORDERS) - 1
        counts = sum(_piece_counts(points[a : a + step + lap]) for a in range(0, len(points), step))
    found = np.flatnonzero(counts)
    return found, counts[found]


def tfidf(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[found]
    return (x / np.sqrt((x * x).sum())).astype(np.float32)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        found, counts = ngram_counts(text)
        if not len(found) or not self.languages:
            return UNDETERMINED, 0.0
        x = tfidf(found, counts, self.idf)
        p = softmax((x @ self.weights[found] + self.weights[FEATURES]) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


class Ftrl:
    """FTRL-proximal for a softmax over ``classes``; the last feature is the unpenalised constant."""

    def __init__(self, classes: int):
        self.z = np.zeros((FEATURES + 1, classes))
        self.n = np.zeros((FEATURES + 1, classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(np.asarray(at) == FEATURES, 0.0, L1)[:, None]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, found: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(found, FEATURES), np.append(x, 1.0)
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p[None, :]
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def best_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the smallest negative log-likelihood, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(scores / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _frequencies(batches):
    """Rows (feature, lang, documents): in how many documents a feature is, and how many a language has."""
    total, languages = np.zeros(FEATURES, np.int64), {}
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
            found, _ = ngram_counts(text.as_py())
            if len(found):
                total[found] += 1
                languages[lang.as_py()] = languages.get(lang.as_py(), 0) + 1
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([pa.array(found, pa.int64()), pa.nulls(len(languages), pa.int64())]),
            pa.concat_arrays([pa.nulls(len(found), pa.string()), pa.array(list(languages), pa.string())]),
            pa.concat_arrays([pa.array(total[found], pa.int64()), pa.array(list(languages.values()), pa.int64())]),
        ],
        names=["feature", "lang", "documents"],
    )


def _vectors_of(most: int):
    def vectors(batches):
        for batch in batches:
            texts = [pieces(text.as_py().encode(), most).decode(errors="ignore") for text in batch.column("text")]
            rows = [ngram_counts(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    batch.column("place"),
                    pa.array([f.astype(np.int32).tobytes() for f, _ in rows], pa.binary()),
                    pa.array([c.astype(np.int32).tobytes() for _, c in rows], pa.binary()),
                ],
                names=["lang", "place", "found", "counts"],
            )

    return vectors


def train(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    sample_bytes: int = SAMPLE_BYTES,
) -> LanguageModel:
    """A model of the given documents; those without text, letters or lang teach nothing.

    Every language gets an even share of ``sample`` documents, chosen by a hash
    of id and text; a fifth of them only sets the temperature. Of a text above
    ``sample_bytes`` pieces that lie evenly all over it teach. What reaches the
    driver is bounded: frequencies of a fixed number of features, the counts of
    the languages, and the sample's n-gram counts.
    """
    labelled = documents.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.xxhash64(F.lit("langid"), id_col, text_col).alias("place"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    frequencies = (
        in_arrow(labelled.select("text", "lang"), _frequencies, "feature long, lang string, documents long")
        .groupBy("feature", "lang")
        .agg(F.sum("documents").alias("documents"))
        .toPandas()
    )
    features = frequencies[frequencies["feature"].notna()]
    counts = frequencies[frequencies["feature"].isna()].set_index("lang")["documents"].sort_index()
    languages = counts.index.tolist()
    documents_seen = int(counts.sum())
    idf = np.full(FEATURES, np.log(1 + documents_seen) + 1)
    idf[features["feature"].to_numpy(int)] = np.log((1 + documents_seen) / (1 + features["documents"].to_numpy(float))) + 1
    if not languages:
        return LanguageModel([], idf, np.zeros((FEATURES + 1, 0), np.float32), 1.0)
    quota = -(-sample // len(languages))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2 * quota / n))])
    chosen = (
        labelled.where(F.col("text") != "")
        .where(F.pmod(F.xxhash64("place"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
        .orderBy("place")
        .limit(2 * quota * len(languages))
    )
    rows = in_arrow(chosen, _vectors_of(sample_bytes), "lang string, place long, found binary, counts binary").toPandas()
    rows = rows.sort_values("place").groupby("lang").head(quota).sort_values("place")
    index = {lang: n for n, lang in enumerate(languages)}
    vectors = []
    for lang, found, counted in zip(rows["lang"], rows["found"], rows["counts"], strict=True):
        found = np.frombuffer(found, np.int32)
        if len(found):
            vectors.append((index[lang], found, tfidf(found, np.frombuffer(counted, np.int32), idf)))
    learner, taught = Ftrl(len(languages)), [v for n, v in enumerate(vectors) if n % 5]
    for _ in range(EPOCHS):
        for label, found, x in taught:
            learner.learn(found, x, label)
    weights = learner.weights(np.arange(FEATURES + 1)).astype(np.float32)
    held = [v for n, v in enumerate(vectors) if n % 5 == 0]
    scores = np.array([x @ weights[found] + weights[FEATURES] for _, found, x in held]).reshape(len(held), len(languages))
    return LanguageModel(languages, idf.astype(np.float32), weights, best_temperature(scores, np.array([v[0] for v in held], int)))


def held_out(doc_id: Column, of: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id is not held out."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(of)) == remainder, F.lit(False))


def identify(documents: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (the calibrated probability of lang_pred).

    Only the text is looked at. A null, empty or letterless text, or a model
    that never saw a language, gives ``und`` with score 0. Repeated rows get
    equal results; an empty table gives none.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for batch in batches:
            found = [shared.value.predict(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    kind = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return in_arrow(rows, predict, f"doc_id {kind}, lang_pred string, score double")
