"""Operators on documents against brute force, on rows with every odd case."""

import itertools
import math
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from odd import edited, frame, prose
from pyspark.sql import functions as F

from clicktrail.llm import decontaminate, hashing, jaccard, langid, line_dedup, mixing, quality, substrings


def table(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_jaccard_components_equal_brute_force(documents, rows):
    got = table(jaccard.jaccard_components(documents), "doc_id", "n_shingles", "component_id")
    assert got == Counter(brute.jaccard(rows))


def test_jaccard_of_large_groups_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BITMAP_BLOCK", 8)
    monkeypatch.setattr(jaccard, "EXACT_BLOCK", 4)
    base = prose(50, 60)
    rows = [(n, edited(base, n, n % 5)) for n in range(40)] + [(100 + n, prose(200 + n, 30)) for n in range(5)]
    got = table(jaccard.jaccard_components(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert got == Counter(brute.jaccard(rows))


@pytest.mark.parametrize("n", [1, 4, 5, 99, 100, 101])
def test_prefixes_of_similar_sets_meet(n):
    least = -(-80 * n // 100)
    assert jaccard.prefix_length(n, 80) == n - least + 1
    assert 1 <= jaccard.prefix_length(n, 80) <= n


def test_dual_traversal_never_drops_a_similar_pair():
    rng = np.random.default_rng(0)
    base = [rng.integers(0, 2**63, 300, dtype=np.uint64) for _ in range(6)]
    sets = []
    for n in range(120):
        s = base[n % 6].copy()
        s[rng.choice(300, n % 50, replace=False)] = rng.integers(0, 2**63, n % 50, dtype=np.uint64)
        sets.append(np.unique(s[: 300 - n]))
    sizes = np.array([len(s) for s in sets])
    found = set()
    for x, y, bound in jaccard.dual_traversal([jaccard.signature(s) for s in sets], sizes, np.zeros(120, int), 80):
        found |= {(min(p, q), max(p, q), int(b)) for p, q, b in zip(x, y, bound, strict=True)}
    assert len({f[:2] for f in found}) == len(found)
    kept = {f[:2]: f[2] for f in found}
    for p in range(120):
        for q in range(p + 1, 120):
            both = len(np.intersect1d(sets[p], sets[q]))
            if 100 * both >= 80 * (sizes[p] + sizes[q] - both):
                assert kept[p, q] >= both


def test_substrings_equal_brute_force(documents, rows):
    got = table(substrings.dedup_substrings(documents), "doc_id", "n_words", "n_removed", "kept")
    assert got == Counter(brute.substrings(rows))


def test_substring_spans_are_maximal(documents):
    for row in substrings.dedup_substrings(documents).collect():
        spans = [(s["first"], s["last"]) for s in row.spans]
        assert sum(b - a + 1 for a, b in spans) == row.n_removed
        assert all(b - a + 1 >= 13 for a, b in spans)
        assert all(spans[n][1] + 1 < spans[n + 1][0] for n in range(len(spans) - 1))


def test_substrings_meet_across_batches(spark):
    """A passage of many documents, fed to the reducer in tiny batches."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        passage = prose(60, 25)
        rows = [(n, f"{prose(300 + n, 10)} {passage} {prose(400 + n, 10)}") for n in range(20)]
        got = table(substrings.dedup_substrings(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == Counter(brute.substrings(rows))


def test_runs_of_a_hot_anchor_spread_by_their_windows(spark, monkeypatch):
    """A phrase that wins the windows around it, in every document, with other words around it in each but a few."""
    phrases = [prose(n, 4) for n in range(3000)]

    def hash_of(phrase):
        data, offsets = hashing.text_buffers(pa.array([phrase]))
        return hashing.shingles(hashing.word_hashes(data, offsets, lower=False)[0], substrings.GRAM)[0]

    phrase = min(phrases, key=hash_of)
    rows = [(n % 70, f"{prose(1000 + n % 60, 14)} {phrase} {prose(1100 + n % 65, 14)}") for n in range(80)] + [(None, None), (None, phrase)]
    monkeypatch.setattr(substrings, "HOT_RUNS", 8, raising=False)
    monkeypatch.setattr(substrings, "OFTEN", 2, raising=False)
    met = []
    sorted_runs = substrings.in_arrow

    def noted(df, function, schema):
        if schema == substrings.SPANS:
            met.append(df)
        return sorted_runs(df, function, schema)

    monkeypatch.setattr(substrings, "in_arrow", noted)
    got = table(substrings.dedup_substrings(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept")
    assert got == Counter(brute.substrings(rows))
    most = met[0].groupBy("anchor").agg(F.countDistinct("tags").alias("n")).agg(F.max("n")).first()[0]
    assert most <= 8


def test_line_dedup_equals_brute_force(documents, rows):
    out = line_dedup.dedup_lines(documents)
    got = table(out, F.col("doc.doc_id"), "n_lines", "n_removed", "kept")
    assert got == Counter(brute.line_dedup(rows))
    assert out.schema["doc"].dataType == documents.schema


def test_decontamination_equals_brute_force(spark, documents, rows):
    lone = prose(70, 24)
    items = [
        (1, prose(2, 20)), (2, lone), (3, edited(prose(1, 120), 9, 1)), (4, None), (5, ""), (6, "word"),
        (7, "five words are one shingle"), (None, prose(2, 20).upper()), (8, "missing item of words nowhere else"),
        (9, " ".join(["again"] * 9)),
    ]
    more = [
        (30, prose(71, 40) + " " + edited(lone, 5, 1) + " " + prose(72, 40)),
        (31, prose(73, 40) + " " + " ".join(lone.split(" ")[:15])),
        (32, " ".join(lone.split(" ")[:21])),
        (33, "again " * 12),
    ]
    docs = documents.unionByName(frame(spark, more))
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, id string")
    got = decontaminate.contaminated(docs, bench)
    assert {(r.doc_id, r.item_id): (r.similarity, r.start, r.n_words, r.n_windows) for r in got.collect()} == brute.leaks(
        rows + more, items
    )


def test_similar_windows_with_other_runs_of_one_word_are_found(spark):
    """Equal but for a run of one repeated word: Jaccard 0.8, and the SimHashes differ in many bits."""
    items, docs = [], []
    for n in range(8):
        head, tail = prose(700 + n, 100 + n), prose(800 + n, 175 - n)
        items.append((n, f"{head} {'_ ' * 29}{tail}"))
        docs.append((n, f"{head} {f'{n} ' * 29}{tail}"))
    items.append((8, " ".join([prose(720, 3)] * 40)))
    docs.append((8, " ".join([prose(720, 3)] * 33)))
    want = brute.leaks(docs, items)
    assert len(want) == 9
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(frame(spark, docs), bench)
    assert {(r.doc_id, r.item_id): (r.similarity, r.start, r.n_words, r.n_windows) for r in got.collect()} == want
    old = decontaminate.benchmark_items(bench).alias("a").join(
        decontaminate.benchmark_items(frame(spark, docs), "doc_id").alias("b"), "item_id"
    )
    far = F.bit_count(F.col("a.fingerprint").bitwiseXOR(F.col("b.fingerprint"))) > decontaminate.RADIUS
    assert old.where(far).count() > 0


def test_simhash_is_the_majority_of_bits(spark):
    hashes = [[3, 1, -1], [], [2**62, -(2**63)], list(range(200)), [7] * 70_000]
    df = spark.createDataFrame([(n, h) for n, h in enumerate(hashes)], "n int, h array<long>")
    got = {r.n: r.f for r in df.select("n", decontaminate.simhash(F.col("h")).alias("f")).collect()}
    for n, hs in enumerate(hashes):
        bits = [sum((h >> b) & 1 for h in hs) * 2 > len(hs) for b in range(64)]
        want = sum(1 << b for b in range(64) if bits[b])
        assert got[n] == (want - 2**64 if want >= 2**63 else want)


def test_mixing_meets_its_targets(documents, rows):
    out = mixing.mix(documents, rows_per_range=2).collect()
    assert len(out) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.epochs * r["size"] + r.rest
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = brute.targets(sizes)
    assert Counter((r.doc_id, r["size"]) for r in out) == Counter((i, len(brute.words(t))) for i, t in rows)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert taken[s] == math.floor(want[s] + 1e-6)
    again = mixing.mix(documents.repartition(5), rows_per_range=1000).collect()
    unique = Counter((r.doc_id, r.text_key) for r in out)
    key = lambda r: (r.doc_id, r.text_key)
    assert {key(r): r.taken for r in out if unique[key(r)] == 1} == {key(r): r.taken for r in again if unique[key(r)] == 1}


def test_mixing_caps_a_small_source(spark):
    rows = [(n, prose(n, 50)) for n in range(20)] + [(100, "two words")]
    out = mixing.mix(frame(spark, rows, source=lambda n: "tiny" if n == 20 else f"s{n % 2}")).collect()
    tiny = [r for r in out if r.source == "tiny"]
    assert [(r.taken, r.target, r.epochs) for r in tiny] == [(6, 6.0, 3)]
    assert sum(r.taken for r in out) == pytest.approx(sum(r["size"] for r in out), abs=3)


def test_mixing_counts_rows_of_one_id_and_text(spark):
    many = spark.range(30_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(prose(1, 7)).alias("text"), F.lit("a").alias("source"))
    few = [(n, prose(n, 11), "ab"[n % 2]) for n in range(60)] + [(5, None, "a"), (5, None, "a"), (6, "x", None)]
    docs = many.unionByName(spark.createDataFrame(few, "doc_id long, text string, source string"))
    out = mixing.mix(docs, rows_per_range=500, ranges_per_span=7)
    for groups in (mixing.mixed_groups(docs), mixing.mixed_groups(docs, rows_per_range=500, ranges_per_span=7)):
        assert groups.count() == 63  # equal rows are one
        spans = sorted((r.source or "", r.at, r["size"] * r.copies) for r in groups.where("size > 0").collect())
        assert all(x[0] != y[0] or x[1] + x[2] == y[1] for x, y in itertools.pairwise(spans))
    per_source = out.groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")
    )
    sums = {r.source: r for r in per_source.collect()}
    assert {s: r.n for s, r in sums.items()} == {"a": 30_032, "b": 30, None: 1}
    want = brute.targets({s: r["size"] for s, r in sums.items()})
    assert all(r.taken == math.floor(want[s] + 1e-6) for s, r in sums.items())
    # of equal copies at most one is taken in part
    cut = out.where("source = 'a' and rest > 0 and rest < size").count()
    assert cut <= 1 and out.where("taken < 0 or taken > 3 * size").isEmpty()


def test_language_of_odd_texts(documents, rows):
    texts = [(n, f"the {prose(n, 30)} and the", "en") for n in range(40)] + [
        (100 + n, f"der {prose(n, 30)} äöü und", "de") for n in range(40)
    ]
    spark = documents.sparkSession
    known = spark.createDataFrame([*texts, (200, None, "fr"), (201, "", "fr"), (202, "untold", None)], "doc_id long, text string, lang string")
    model = langid.train(known)
    assert model.languages == ["de", "en"] and 0.05 <= model.temperature <= 20
    found = langid.identify(documents, model).collect()
    assert len(found) == len(rows)
    for r in found:
        text = next(t for i, t in rows if i == r.doc_id)
        assert 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id != 18:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
    own = langid.identify(known, model).join(known.select("doc_id", "lang"), "doc_id").where("lang in ('en', 'de')")
    assert own.where("lang = lang_pred").count() >= 70
    nobody = langid.train(known.where("lang is null"))
    assert {(r.lang_pred, r.score) for r in langid.identify(known, nobody).collect()} == {("und", 0.0)}


def test_ngrams_of_a_long_text_are_those_of_its_pieces(monkeypatch):
    text = "äb c," * 999
    want = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "PIECE", 700)
    found, counts = langid.ngram_counts(text)
    assert set(want[0]) <= set(found) and abs(int(counts.sum() - want[1].sum())) <= 40


def test_quality_scores_are_whole_text_and_separate(spark, documents, rows):
    junk = lambda n: " ".join(f"{w}%%%" for w in prose(n, 40).split())
    docs = [(n, junk(n) if n % 3 == 0 else prose(n, 40) + ".") for n in range(90)]
    known = frame(spark, docs)
    labels = spark.createDataFrame([(n, int(n % 3 > 0), 0) for n in range(60)] + [(500, None, 0), (1, 0, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    net = quality.train(known, labels)
    scored = {r.doc_id: r.predicted for r in quality.score_quality(known, net).select("doc.doc_id", "predicted").collect()}
    assert sum(scored[n] == int(n % 3 > 0) for n in range(60, 90)) >= 28
    out = quality.score_quality(documents, net)
    assert out.schema["doc"].dataType == documents.schema
    assert out.count() == len(rows) and out.where("score between 0 and 1").count() == len(rows)
    one_sided = quality.train(known, labels.where("quality = 1"))
    assert quality.score_quality(known, one_sided).where("predicted = 0").isEmpty()


def test_a_long_text_scores_the_same_in_blocks(monkeypatch):
    net, text = quality.Network.fresh(3), prose(90, 3_000)
    whole = quality.score_batch(net, pa.array([text, "x", ""]))
    monkeypatch.setattr(quality, "BLOCK", 4 * quality.HALF)
    assert np.allclose(quality.score_batch(net, pa.array([text, "x", ""])), whole)


def test_words_hash_alike_whatever_is_around(monkeypatch):
    texts = ["one two", "", "two\tone two", "ONE  Two ", " é one"]
    data, offsets = hashing.text_buffers(pa.array(texts))
    h, bounds = hashing.word_hashes(data, offsets, lower=True)
    parts = [h[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    one, two = parts[0]
    assert parts == [[one, two], [], [two, one, two], [one, two], [parts[4][0], one]]
    monkeypatch.setattr(hashing, "BLOCK_BYTES", 16)
    long = prose(5, 50)
    data, offsets = hashing.text_buffers(pa.array([long]))
    pieces = hashing.word_hashes(data, offsets, lower=False)[0].tolist()
    assert len(pieces) == 50 and len(set(pieces)) == len(set(long.split()))


def test_empty_tables(spark, nothing):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    some = frame(spark, [(1, "a b c d e f")])
    assert jaccard.jaccard_components(nothing).isEmpty()
    assert substrings.dedup_substrings(nothing).isEmpty()
    assert line_dedup.dedup_lines(nothing).isEmpty()
    assert mixing.mix(nothing).isEmpty()
    assert decontaminate.contaminated(nothing, bench).isEmpty()
    assert decontaminate.contaminated(some, bench.limit(0)).isEmpty()
    assert langid.identify(nothing, langid.train(nothing)).isEmpty()
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score_quality(nothing, quality.train(nothing, labels)).isEmpty()
    assert quality.score_quality(some, quality.train(some, labels)).count() == 1


def test_many_rows_of_one_text_and_a_near_copy(spark):
    """A third and more of all rows has no id and one text; one text is almost the same."""
    base = prose(70, 200)
    near = edited(base, 1, 3)
    rows = [(5, near)] + [(n + 10, prose(700 + n, 12)) for n in range(20)]
    many = spark.range(50_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(base).alias("text"))
    out = jaccard.jaccard_classes(frame(spark, rows).select("doc_id", "text").unionByName(many))
    got = table(out.groupBy("doc_id", "n_shingles", "component_id", "leads").count(), "doc_id", "n_shingles", "component_id", "leads", "count")
    sizes = {t: len(brute.shingle_set(t)) for t in (base, near)}
    want = [(None, sizes[base], 5, False, 50_000), (5, sizes[near], 5, True, 1)] + [(i, 8, i, True, 1) for i, _ in rows[1:]]
    assert got == Counter(want)


def test_similarities_below_a_half_are_refused(documents):
    with pytest.raises(ValueError, match="similarity"):
        jaccard.jaccard_classes(documents, similar=49)


def test_rows_without_id_are_told_apart_by_their_whole_text(spark):
    """Two texts without id whose keys agree in their lower 31 bits: what repeats in one is no repeat in the other."""
    texts = spark.range(200_000).select(F.concat(F.lit("t "), F.repeat(F.concat(F.lit(" w"), F.col("id").cast("string")), 25)).alias("text"))
    keyed = texts.select("text", substrings.text_key(F.col("text")).bitwiseAND(F.lit(0x7FFFFFFF)).alias("low"))
    pairs = keyed.groupBy("low").agg(F.collect_list("text").alias("texts")).where("size(texts) > 1").first().texts
    rows = [(1, " ".join(pairs[0].split()[1:15])), (None, pairs[0]), (None, pairs[1])]
    got = table(substrings.dedup_substrings(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept")
    assert got == Counter(brute.substrings(rows))


@pytest.mark.parametrize("window", [3, 259])
def test_windows_out_of_range_are_refused(documents, window):
    with pytest.raises(ValueError, match="window"):
        substrings.repeated_spans(documents, window=window)


def test_windows_of_any_size_have_codes(spark):
    pairs = [(1, 1), (3, 20), (5, (1 << 20) - 1), (5, 1 << 20), (2, (1 << 20) + 7), (1 << 30, (1 << 31) - 1)]
    df = spark.createDataFrame(pairs, "start int, n int").withColumn("code", decontaminate.window_code(F.col("start"), F.col("n")))
    assert Counter(map(tuple, df.select(*decontaminate.window_of(F.col("code"))).collect())) == Counter(pairs)
    assert df.select("code").distinct().count() == len(pairs)


def _alike(seed, alphabet, n):
    import random

    rng = random.Random(seed)
    return " ".join("".join(rng.choices(alphabet, k=5)) for _ in range(n))


def test_labels_of_absent_documents_take_no_place(spark):
    rows = [(n, _alike(n, "abcd" if n % 2 else "wxyz", 20)) for n in range(40)]
    labels = [(n, n % 2) for n in range(40)] + [(1000 + n, n % 2) for n in range(4_000)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    documents = frame(spark, rows)
    net = quality.train(documents, labels, sample=20)
    alone = quality.train(documents, labels.where("doc_id < 1000"), sample=20)
    assert net.constant == alone.constant and (net.filters == alone.filters).all() and net.output.any()


def test_long_texts_of_one_label_teach(spark):
    rows = [(n, _alike(n, "abcd", 20) if n % 2 else _alike(n, "wxyz", 20_000)) for n in range(30)]
    labels = spark.createDataFrame([(n, n % 2) for n in range(30)], "doc_id long, quality int")
    net = quality.train(frame(spark, rows), labels)
    scores = quality.score_batch(net, pa.array([_alike(99, "abcd", 20), _alike(98, "wxyz", 20_000)]))
    assert scores[0] > 0.5 > scores[1]


def test_a_language_of_long_texts_only_is_learnt(spark):
    rows = [(n, _alike(n, "abcd", 20) if n % 2 else _alike(n, "wxyz", 30_000), "ab" if n % 2 else "wx") for n in range(30)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.predict(_alike(99, "wxyz", 10))[0] == "wx" and model.predict(_alike(98, "abcd", 10))[0] == "ab"


def test_scores_equal_plain_loops(spark):
    """The network by loops over bytes, filters and chunks; the language model by dictionaries of n-grams."""
    rng = np.random.default_rng(1)
    net = quality.Network.fresh(3)
    net.output = rng.normal(0, 1, net.output.shape).astype(np.float32)
    for text in ("", "a", "short one", prose(1, 60), prose(2, 300) + "é"):
        data = list(text.encode())
        data += [quality.PAD] * (-(-(len(data) + quality.STRIDE) // quality.HALF) * quality.HALF - len(data))
        places = range(0, len(data), quality.STRIDE)
        outs = []
        for a in places:
            window = data[a : a + quality.WIDTH]
            vector = [x for symbol in window for x in net.embedding[symbol]]
            whole = len(window) == quality.WIDTH
            outs.append([max(0.0, float(np.dot(vector, net.filters[:, f]) + net.offsets[f])) if whole else 0.0 for f in range(quality.FILTERS)])
        per = quality.HALF // quality.STRIDE
        halves = [[max(o[f] for o in outs[h : h + per]) for f in range(quality.FILTERS)] for h in range(0, len(outs), per)]
        chunks = halves if len(halves) == 1 else [[max(x, y) for x, y in zip(a, b, strict=True)] for a, b in zip(halves, halves[1:], strict=False)]
        inner = [[max(0.0, float(np.dot(c, net.hidden[:, h]) + net.hidden_offsets[h])) for h in range(quality.HIDDEN)] for c in chunks]
        pooled = [sum(c[h] for c in inner) / len(inner) for h in range(quality.HIDDEN)] + [max(c[h] for c in inner) for h in range(quality.HIDDEN)]
        want = 1 / (1 + math.exp(-max(-30, min(30, float(np.dot(pooled, net.output)) + net.constant))))
        assert quality.score_batch(net, pa.array([text]))[0] == pytest.approx(want, abs=1e-5)


def test_languages_equal_plain_dictionaries(spark):
    rows = [(n, _alike(n, "abcdé" if n % 2 else "wxyz", 30), "ab" if n % 2 else "wx") for n in range(40)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))

    def feature(gram):
        h = 0
        for c in gram:
            h = (h * 0x01000193 + ord(c) + 1) % 2**32
        h = h * 0x9E3779B1 % 2**32
        h ^= h >> 15
        return (h * 0x85EBCA77 % 2**32) >> 16

    for text in ("Abc, wx!", "dédé  1 2 cab", prose(3, 20)):
        plain = " ".join("".join(c if c.isalpha() else " " for c in f" {text.lower()} ").split())
        plain = f" {plain} "
        counts = Counter(feature(plain[i : i + n]) for n in langid.ORDERS for i in range(len(plain) - n + 1))
        x = {f: (1 + math.log(c)) * model.idf[f] for f, c in counts.items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        scores = [sum(v / norm * model.weights[f, k] for f, v in x.items()) + model.weights[langid.FEATURES, k] for k in range(2)]
        e = [math.exp(s / model.temperature) for s in scores]
        lang, score = model.predict(text)
        assert score == pytest.approx(max(e) / sum(e), abs=1e-4) and lang == model.languages[e.index(max(e))]
