"""Stages of the corpus pipeline on rows with repeated and null ids, against brute force."""

from collections import Counter, defaultdict

import brute
import pyarrow as pa
import pytest
from odd import edited, frame, prose

import corpus_pipeline
from clicktrail.llm import mixing, quality


HUGE = 2**63 - 1


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def check_one_of_each_group(got, rows):
    members = defaultdict(list)
    for row, g in zip(rows, brute.groups(rows), strict=True):
        members[g].append(row)
    assert not got - Counter(rows)
    left = Counter(got)
    for some in members.values():
        kept = [row for row in set(some) for _ in range(got[row])]
        if brute.words(some[0][1]):
            assert len(kept) == 1 and brute.order(kept[0][0]) == min(brute.order(i) for i, _ in some)
        else:
            assert Counter(kept) == Counter(some)
        left -= Counter(kept)
    assert not left


def test_groups_that_share_their_smallest_id_keep_one_document_each(spark):
    base, other = prose(600, 60), prose(601, 60)
    rows = [
        (5, prose(602, 50)), (5, prose(603, 50)), (5, base), (7, edited(base, 1, 1)), (5, prose(604, 50)), (5, base),
        (None, prose(605, 50)), (None, prose(606, 50)), (None, other), (None, edited(other, 2, 1)), (None, other),
        (None, None), (None, ""), (5, " "),
    ]
    got = pairs(corpus_pipeline.near_duplicates(spark, frame(spark, rows), ""))
    check_one_of_each_group(got, rows)


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd-pipeline"))
    labels = [(n, n % 2, 0) for n in range(1, 24)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, prose(2, 20)), (2, None), (3, "word"), (None, prose(9, 5))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def test_stages_on_odd_rows_equal_brute_force(spark, documents, rows, odd_dir):
    path, items = odd_dir
    net = quality.train(documents, corpus_pipeline.read_table(spark, path, "labels"))
    got = pairs(corpus_pipeline.quality_filter(spark, documents, path))
    good = lambda t: quality.score_batch(net, pa.array([t], pa.string()))[0] >= quality.THRESHOLD
    assert got == Counter(r for r in rows if good(r[1]))
    got = pairs(corpus_pipeline.line_filter(spark, documents, path))
    assert got == Counter((i, t) for i, n, gone, t in brute.line_dedup(rows) if not gone or gone < n)
    check_one_of_each_group(pairs(corpus_pipeline.near_duplicates(spark, documents, path)), rows)
    got = pairs(corpus_pipeline.decontamination(spark, documents, path))
    assert got == Counter(r for r in rows if not brute.leaks([r], items))
    mixed = corpus_pipeline.mixing(spark, documents, path).collect()
    assert all(0 < r.taken == r.epochs * r["size"] + r.rest and r["size"] == len(brute.words(r.text)) for r in mixed)
    assert not Counter((r.doc_id, r.text) for r in mixed) - Counter(rows)


def test_equal_rows_of_many_sources_are_mixed_in_their_own(spark):
    text = prose(700, 9)
    rows = [(None, text)] * 40 + [(HUGE, text)] * 3 + [(n, prose(n, 9)) for n in range(30)]
    docs = frame(spark, rows, source=lambda n: ["a", "b", None][n % 3])
    mixed = mixing.mix(docs).where("taken > 0")
    per_row = lambda rows: Counter((r.doc_id, r.source, r.taken) for r in rows)
    assert per_row(corpus_pipeline.mixing(spark, docs, "").collect()) == per_row(mixed.collect())


def test_half_of_the_rows_repeat_one_row(spark):
    text, rare = prose(800, 40), [(n, prose(900 + n, 40)) for n in range(50)]
    near = edited(text, 3, 1)
    docs = frame(spark, [(None, text)] * 2_000 + [(None, near)] + rare)
    got = pairs(corpus_pipeline.near_duplicates(spark, docs, ""))
    assert sum(got.values()) == 51 and sum(got[(None, t)] for t in (text, near)) == 1
