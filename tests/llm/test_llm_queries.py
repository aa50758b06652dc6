"""The registered queries against SQL, brute force or held-out accuracy, on the smallest data set."""

import hashlib
import os
import zlib
from collections import Counter

import brute
import duckdb
import pytest

import corpus_pipeline
from clicktrail.llm import oracles, queries, quality
from clicktrail.llm.common import read_table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
QUERIES, ORACLES = queries.all_queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text, lang FROM documents").fetchall()


def canonical(columns, rows):
    at = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(row[i] for i in at) for row in rows)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    answer = duck.execute(ORACLES[name])
    columns = [column[0] for column in answer.description]
    assert sorted(result.columns) == sorted(columns)
    assert canonical(result.columns, result.collect()) == canonical(columns, answer.fetchall())


def test_jaccard_query_equals_brute_force(spark, documents):
    got = QUERIES["op3_jaccard_join"](spark, SF_DIR).collect()
    want = brute.jaccard([row[:2] for row in documents])
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(want)


def test_languages_of_held_out_documents(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, SF_DIR).collect()}
    assert len(got) == len(documents)
    held = [(got[i], lang) for i, _, lang in documents if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {r.doc_id for r in got.values() if r.held_out} == {r.doc_id for r, _ in held}
    assert sum(r.lang_pred == lang for r, lang in held) >= 0.95 * len(held)


def test_quality_of_held_out_documents(spark, duck):
    got = {r.doc_id: r for r in QUERIES["op9_quality_classifier"](spark, SF_DIR).collect()}
    labels = duck.execute("SELECT doc_id, quality FROM labels").fetchall()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[i], q) for i, q in labels if got[i].held_out]
    assert sum(r.predicted == q for r, q in held) >= 0.75 * len(held)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())


def test_pipeline_equals_brute_force(spark, duck):
    """Stage by stage on what the stage before kept; the first with the network's own scores of single texts."""
    docs = read_table(spark, SF_DIR, "documents")
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    kept = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "test-stage")
        rows = docs.collect()
        got = {r.doc_id: r.text for r in rows}
        assert len(rows) == len(got)
        if name != "source mixing":
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "quality classifier":
            net = quality.train(read_table(spark, SF_DIR, "documents"), read_table(spark, SF_DIR, "labels"))
            import pyarrow as pa

            scores = {i: quality.score_batch(net, pa.array([t]))[0] for i, t in kept.items()}
            want = {i: t for i, t in kept.items() if scores[i] >= quality.THRESHOLD}
        elif name == "line dedup":
            want = {i: t for i, n, gone, t in brute.line_dedup(list(kept.items())) if not gone or gone < n}
        elif name == "n-gram Jaccard join":
            want = {i: kept[i] for i, n, c in brute.jaccard(list(kept.items())) if i == c}
        elif name == "benchmark decontamination":
            leaked = {i for i, _ in brute.leaks(list(kept.items()), items)}
            want = {i: t for i, t in kept.items() if i not in leaked}
        else:
            mixed = {r.doc_id: r for r in rows}
            sizes = Counter()
            source = dict(duck.execute("SELECT doc_id, source FROM documents").fetchall())
            for i, t in kept.items():
                sizes[source[i]] += len(brute.words(t))
            taken = Counter()
            for r in rows:
                assert 0 < r.taken <= 3 * r["size"] and r["size"] == len(brute.words(kept[r.doc_id]))
                taken[source[r.doc_id]] += r.taken
            assert all(abs(taken[s] - t) < 1.01 for s, t in brute.targets(sizes).items())
            want = {i: kept[i] for i in mixed}
        assert got == want, name
        kept = got


def test_pipeline_runs_all_stages(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "source mixing",
    ]
    assert out.count() == out.select("doc_id").distinct().count() > 0


def test_digests_are_of_the_operators_texts(spark):
    from clicktrail.llm import substrings

    texts = {r.doc_id: r.kept for r in substrings.dedup_substrings(read_table(spark, SF_DIR, "documents")).collect()}
    for r in QUERIES["op5_substring_dedup"](spark, SF_DIR).collect():
        assert r.kept_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
