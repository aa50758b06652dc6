"""Importance resampling against brute force; CRCs against zlib."""

import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from odd import frame, prose

from clicktrail.llm import crc, resampling


@pytest.mark.parametrize("at_once", [50, crc.AT_ONCE])
def test_crcs_equal_zlib(monkeypatch, at_once):
    monkeypatch.setattr(crc, "AT_ONCE", at_once)
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 20_000, dtype=np.uint8)
    lengths = np.array([0, 1, 2, 63, 64, 65, 127, 128, 129, 192, 193, 4_096, 4_097, 10_000, *rng.integers(0, 300, 200)])
    starts = rng.integers(0, 10_000, len(lengths))
    raw = data.tobytes()
    want = [zlib.crc32(raw[a : a + n]) for a, n in zip(starts, lengths, strict=True)]
    assert crc.span_crcs(data, starts, lengths).tolist() == want
    assert crc.span_crcs(data, starts[:0], lengths[:0]).tolist() == []


def test_features_are_words_and_pairs_within_a_text():
    texts = ["One two!two", None, "", "...", "é_3", "x" * 500 + " Y", "a"]
    got = {n: Counter() for n in range(len(texts))}
    for i, _, counts, found, text in resampling.text_buckets(pa.array(texts)):
        assert counts.tolist() == [3, 0, 0, 0, 2, 2, 1]
        for f, n in zip(found.tolist(), text.tolist(), strict=True):
            got[n + i][f] += 1
    want = [["one", "two", "two", "one two", "two two"], [], [], [], ["é", "3", "é 3"], ["x" * 500, "y", "x" * 500 + " y"], ["a"]]
    assert [got[n] for n in range(len(texts))] == [Counter(zlib.crc32(f.encode()) % 10_000 for f in fs) for fs in want]


COLUMNS = ("doc_id", "n_words", "n_features", "weight", "score", "rank")


def table(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_resampling_equals_brute_force(spark, documents, rows):
    items = [None, "", prose(1, 40), prose(3, 200), "..."]
    target = spark.createDataFrame([(n, t, "clash") for n, t in enumerate(items)], "item_id long, text string, bucket string")
    assert table(resampling.resample(documents, target)) == Counter(brute.resampling(rows, items))


def test_a_third_of_all_rows_is_one_row(spark):
    rows = [(n, prose(n, 25 + n % 7)) for n in range(60)] + [(None, prose(99, 30))] * 35 + [(5, prose(98, 22))] * 5
    target = spark.createDataFrame([(prose(99, 30),)], "text string")
    out = resampling.resample(frame(spark, rows), target, share=50)
    assert table(out) == Counter(brute.resampling(rows, [prose(99, 30)], share=50))
    assert sorted(r["rank"] for r in out.collect() if r["rank"]) == list(range(1, 51))


def test_empty_tables(spark, documents, nothing, rows):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(nothing, none).count() == 0
    assert table(resampling.resample(documents, none)) == Counter(brute.resampling(rows, []))
