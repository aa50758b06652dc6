"""Importance resampling of documents towards a target distribution.

Texts are bags of hashed word n-grams (runs of one and two words), a feature's
bucket being its CRC-32 modulo the number of buckets. From the bucket counts of
all documents and of all target texts every bucket gets a gain, the logarithm
of how much likelier it is in the target, in whole thousandths. A document's
weight is the floored mean gain of its features. Gumbel noise that depends on
the document's id alone is added, and the documents of the greatest sums are
the draw: a sample without replacement in proportion to the weights.

Counts cover all texts. What reaches the driver is one number per bucket, and
one row per distinct score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm import hashing
from clicktrail.llm.common import in_arrow, stored
from clicktrail.llm.crc import span_crcs

BUCKETS = 10_000
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
#: Hundredths of the eligible documents that are drawn.
SHARE = 25
SEED = 7
SPACE = 0x20


def _word_bytes() -> np.ndarray:
    """Which bytes belong to words: digits, letters, and all of UTF-8 beyond ASCII."""
    table = np.zeros(256, bool)
    table[ord("0") : ord("9") + 1] = table[ord("a") : ord("z") + 1] = table[0x80:] = True
    return table


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


WORD_BYTES, LOWERED = _word_bytes(), _lowered()


def words_by_spaces(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts' words with one space after each: bytes, starts and lengths of the words, and where each text's words begin.

    ``bounds`` are the texts' offsets in ``data``, one entry more than texts.
    """
    low = LOWERED[data]
    letter = WORD_BYTES[low]
    begins, ends = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1]
    ends[:-1] &= ~letter[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] |= letter[inner]
    ends[inner - 1] |= letter[inner - 1]
    first, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    lengths = stop - first
    starts = np.cumsum(lengths + 1) - lengths - 1
    out = np.empty(int(lengths.sum()) + len(lengths), np.uint8)
    gap = np.zeros(len(out), bool)
    gap[starts + lengths] = True
    out[gap], out[~gap] = SPACE, low[letter]
    return out, starts, lengths, np.searchsorted(first, bounds)


def text_buckets(texts: pa.Array, buckets: int = BUCKETS):
    """For runs of texts (first, one behind the last): words of each text, buckets of all features, text of each feature."""
    data, offsets = hashing.text_buffers(texts)
    for i, j in hashing.text_slices(offsets):
        bounds = offsets[i : j + 1] - offsets[i]
        spaced, starts, lengths, at = words_by_spaces(data[offsets[i] : offsets[j]], bounds)
        counts = np.diff(at)
        text = np.repeat(np.arange(j - i), counts)
        pair = np.flatnonzero(text[1:] == text[:-1])
        begin = np.concatenate([starts, starts[pair]])
        length = np.concatenate([lengths, lengths[pair] + 1 + lengths[pair + 1]])
        yield i, j, counts, span_crcs(spaced, begin, length) % np.uint32(buckets), np.concatenate([text, text[pair]])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts (column ``text``) fall into each bucket."""

    def counts(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, found, _ in text_buckets(batch.column("text"), buckets):
                total += np.bincount(found, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "features"])

    rows = in_arrow(texts, counts, "bucket long, features long").groupBy("bucket").agg(F.sum("features").alias("features"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():  # at most one row a bucket
        out[row.bucket] = row.features
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths: the log ratio of its smoothed shares in the target and in the documents."""
    s, t, n = raw.astype(float), target.astype(float), float(len(raw))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise of a document in thousandths, out of its id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _texts(rows: DataFrame, text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")


def importance_scores(
    documents: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score."""
    gains = bucket_gains(
        bucket_counts(documents.select(_texts(documents, text_col)), buckets),
        bucket_counts(target.select(_texts(target, target_col)), buckets),
    )
    shared = documents.sparkSession.sparkContext.broadcast(gains)

    def sums(batches):
        for batch in batches:
            words = np.zeros(batch.num_rows, np.int64)
            features, gained = words.copy(), words.copy()
            for i, j, counts, found, text in text_buckets(batch.column("text"), buckets):
                words[i:j] = counts
                features[i:j] = np.bincount(text, minlength=j - i)
                # sums of whole numbers, exact in doubles
                gained[i:j] = np.bincount(text, shared.value[found], j - i).astype(np.int64)
            columns = [batch.column("doc_id"), *(pa.array(c) for c in (words, features, gained))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "gained"])

    kind = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(F.col(id_col).alias("doc_id"), _texts(documents, text_col))
    summed = in_arrow(rows, sums, f"doc_id {kind}, n_words long, n_features long, gained long")
    # an exact floor: the remainder of a negative sum is moved up to 0 and more
    count = F.greatest(F.col("n_features"), F.lit(1))
    weight = ((F.col("gained") - F.pmod(F.col("gained"), count)) / count).cast("long")
    return (
        summed.withColumn("weight", weight)
        .withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
        .drop("gained")
    )


def resample(
    documents: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    share: int = SHARE,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (from 1 in the draw; null if not drawn).

    Texts are lower-cased in A-Z only. Null, empty and wordless texts have no
    features and weight 0; a document below ``least_words`` words is never
    drawn. A null id draws its noise as an empty one and comes after all others
    among ties. Rows that repeat an id are documents of their own with the same
    noise; ties between them go by fewer features, then smaller weight, and
    rows equal in all that take consecutive ranks. An empty target or table
    counts nothing: the gains are then 0 or the smoothed shares alone. Other
    columns are not looked at.
    """
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    scores = importance_scores(documents, target, id_col, text_col, target_col, buckets, seed)
    # equal rows as one with a count, so that no key gathers them
    scored = stored(scores.groupBy(columns).agg(F.count(F.lit(1)).alias("copies")), "resampling-scores")
    able = F.col("n_words") >= least_words
    # Weights and noise are whole numbers within some ten thousand of 0, so the scores are some ten thousand at most.
    heights = scored.where(able).groupBy(F.col("score").alias("height")).agg(F.sum("copies").alias("n"))
    higher = Window.orderBy(F.desc("height")).rowsBetween(Window.unboundedPreceding, -1)
    above = heights.select(
        "height",
        F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("above"),
        F.floor(F.sum("n").over(Window.partitionBy()) * share / 100).alias("drawn"),
    )
    # By the noise no score has more than about 0.04 % of all distinct ids.
    smaller = (
        Window.partitionBy("score")
        .orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight", "n_words")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = scored.join(above, able & (F.col("score") == F.col("height")), "left")
    reached = F.col("above") < F.col("drawn")
    before = F.col("above") + F.coalesce(F.sum("copies").over(smaller), F.lit(0))
    ranked = joined.where(reached).withColumn("before", before)
    others = joined.where(~F.coalesce(reached, F.lit(False))).withColumn("before", F.lit(None).cast("long"))
    copied = ranked.unionByName(others).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    rank = F.col("before") + F.col("copy")
    return copied.select(*columns, F.when(rank <= F.col("drawn"), rank).alias("rank"))
