"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of the ten 4-word grams inside each window of 13
words, the one with the smallest hash. Equal windows choose equal anchors, so
documents only need to meet on anchors; each anchor carries the run of
consecutive windows that chose it, extended both ways as far as they reach.
Where documents meet, windows whose words also start in a document with a
smaller id are marked, and marked neighbours merge into maximal repeats.

Runs that already met their equal from a smaller document inside a map task
are decided there and not sent, so a passage of many copies reaches its
anchor's task at most once a batch.

Runs are counted first. Those of a hot anchor (a frequent phrase among ever
different words) are cut into single windows, which meet under a hash of the
anchor and the window instead: its windows spread over all tasks, and no task
holds more than one window's smallest id for them.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clicktrail.llm import hashing
from clicktrail.llm.common import in_arrow, text_key

WINDOW = 13
GRAM = 4
#: Windows meet under a 64-bit anchor and are told apart by 48 bits more.
TAG_BYTES = 6
#: Sorts a null id after all others.
NO_ID = 2**63 - 1
CODEC = "zstd"

#: Hot anchors: at most so many, with so many runs at least. Anchors are counted in stretches of so many runs, and
#: those with fewer than so many runs of a stretch are left out.
HOT, HOT_RUNS, STRETCH, OFTEN = 1 << 17, 1_000, 1 << 20, 16

#: Runs that are prepared at once.
AT_ONCE = 1 << 15
#: A decided run is sent as its length in one byte.
LONGEST_RUN = 255

RUNS = "anchor long, id long, tk long, start int, tags binary"
SPANS = "id long, tk long, first long, last long"


def _batch_runs(ids, tks, texts: pa.Array, window: int, gram: int):
    """Runs of one batch: anchor, id, text key, start, windows' tags (flat) and offsets of the runs in them."""
    data, offsets = hashing.text_buffers(texts)
    found = []
    for i, j in hashing.text_slices(offsets):
        words, bounds = hashing.word_hashes(data, offsets[i : j + 1], lower=False)
        n = len(words) - window + 1
        if n <= 0:
            continue
        grams = hashing.shingles(words, gram)
        valid = np.flatnonzero(hashing.inside(bounds, window, n))
        if not len(valid):
            continue
        spread = window - gram + 1
        views = np.lib.stride_tricks.sliding_window_view(grams, spread)[:n]
        best = np.empty(n, np.int64)
        for a in range(0, n, 1 << 16):
            best[a : a + (1 << 16)] = views[a : a + (1 << 16)].argmin(axis=1)
        seed = (best + np.arange(n))[valid]
        tags = hashing.shingles(words, window)[valid]
        document = np.searchsorted(bounds, valid, side="right") - 1
        new = np.ones(len(valid), bool)
        new[1:] = (np.diff(seed) != 0) | (np.diff(document) != 0)
        head = np.flatnonzero(new)
        of = document[head] + i
        start = valid[head] - bounds[document[head]]
        found.append((grams[seed[head]].view(np.int64), ids[of], tks[of], start, tags, np.diff(np.append(head, len(valid)))))
    if not found:
        return None
    anchor, id_, tk, start, tags, lengths = (np.concatenate(c) for c in zip(*found, strict=True))
    return anchor, id_, tk, start.astype(np.int32), tags, np.concatenate([[0], np.cumsum(lengths)])


def _decided(anchor, id_, tags, offsets) -> np.ndarray:
    """Which runs have their equal from a smaller id among these."""
    sums = np.empty(len(anchor), np.uint64)
    for a in range(0, len(anchor), AT_ONCE):
        b = min(a + AT_ONCE, len(anchor))
        sums[a:b] = np.add.reduceat(hashing.mixed(tags[offsets[a] : offsets[b]]), offsets[a:b] - offsets[a])
    content = hashing.mixed(sums).view(np.int64) ^ anchor
    order = np.lexsort((id_, content))
    same = np.zeros(len(order), bool)
    same[1:] = content[order][1:] == content[order][:-1]
    group = np.cumsum(~same) - 1
    smallest = id_[order][~same][group]
    decided = np.empty(len(order), bool)
    decided[order] = id_[order] > smallest
    return decided


def _cut_runs(hot: np.ndarray, anchor, id_, tk, start, tags, offsets, decided):
    """The runs with those of hot anchors, unless decided, as single windows; equal windows are decided like runs."""
    cut = np.isin(anchor, hot) & ~decided
    lengths = np.diff(offsets)
    within = np.repeat(cut, lengths)
    run = np.repeat(np.flatnonzero(cut), lengths[cut])
    place = np.arange(len(run)) - np.repeat(np.cumsum(lengths[cut]) - lengths[cut], lengths[cut])
    own = tags[within]
    apart = hashing.mixed(hashing.mixed(own) ^ anchor[run].view(np.uint64)).view(np.int64)
    known = _decided(apart, id_[run], own, np.arange(len(run) + 1))
    join = lambda whole, single: np.concatenate([whole[~cut], single])
    return (
        join(anchor, apart), join(id_, id_[run]), join(tk, tk[run]), join(start, start[run] + place.astype(np.int32)),
        np.concatenate([tags[~within], own]),
        np.concatenate([[0], np.cumsum(join(lengths, np.ones(len(run), np.int64)))]), join(decided, known),
    )


def _anchor_counts_of(window: int, gram: int, stretch: int, often: int):
    """Anchors with how many undecided runs a stretch of runs has under them, if often enough."""

    def count_rows(anchors):
        values, times = np.unique(np.concatenate(anchors), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values[times >= often]), pa.array(times[times >= often])], names=["anchor", "times"])

    def counts(batches):
        anchors, held = [], 0
        for batch in batches:
            ids, tks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tk"))
            made = _batch_runs(ids, tks, batch.column("text"), window, gram)
            if made is None:
                continue
            anchor, id_, _, _, tags, offsets = made
            anchors.append(anchor[~_decided(anchor, id_, tags, offsets)])
            held += len(anchors[-1])
            if held >= stretch:
                yield count_rows(anchors)
                anchors, held = [], 0
        if held:
            yield count_rows(anchors)

    return counts


def _runs_of(window: int, gram: int, hot: np.ndarray):
    def runs(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            tks = batch.column("tk").to_numpy(zero_copy_only=False)
            made = _batch_runs(ids, tks, batch.column("text"), window, gram)
            if made is None:
                continue
            anchor, id_, tk, start, tags, offsets = made
            decided = _decided(anchor, id_, tags, offsets)
            if len(hot):
                anchor, id_, tk, start, tags, offsets, decided = _cut_runs(hot, anchor, id_, tk, start, tags, offsets, decided)
            # a decided run is one byte, its length, and goes wherever its document hashes to
            own = hashing.mixed((tk ^ id_).view(np.uint64) + start.astype(np.uint64)).view(np.int64)
            route = np.where(decided, own, anchor)
            for a in range(0, len(route), AT_ONCE):
                b = min(a + AT_ONCE, len(route))
                gone, lengths = decided[a:b], np.diff(offsets[a : b + 1])
                kept = tags[offsets[a] : offsets[b]][np.repeat(~gone, lengths)]
                ends = np.concatenate([[0], np.cumsum(np.where(gone, 1, lengths * TAG_BYTES))])
                out = np.empty(ends[-1], np.uint8)
                single = np.zeros(ends[-1], bool)
                single[ends[:-1][gone]] = True
                out[single], out[~single] = lengths[gone], kept.view(np.uint8).reshape(-1, 8)[:, :TAG_BYTES].ravel()
                columns = [*(pa.array(c[a:b]) for c in (route, id_, tk, start)), hashing.binary_column(out, ends)]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "id", "tk", "start", "tags"])

    return runs


def _spans_of(window: int):
    def span_rows(id_, tk, start, first, last):
        columns = [pa.array(c) for c in (id_, tk, start + first, start + last + window - 1)]
        return pa.RecordBatch.from_arrays(columns, names=["id", "tk", "first", "last"])

    def spans(batches):
        """Rows come sorted by anchor and id. What an anchor's windows were first seen in goes on to the next batch."""
        last_anchor, seen_tags, seen_ids = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            anchor, id_, tk, start = (batch.column(c).to_numpy() for c in ("anchor", "id", "tk", "start"))
            if not len(anchor):
                continue
            data, offsets = hashing.binary_buffers(batch.column("tags"))
            sizes = np.diff(offsets)
            decided = sizes == 1
            if decided.any():
                length = data[offsets[:-1][decided]].astype(np.int64)
                yield span_rows(id_[decided], tk[decided], start[decided], np.zeros(len(length), np.int64), length - 1)
            rows = np.flatnonzero(~decided)
            if not len(rows):
                continue
            anchors = anchor[rows]
            goes_on = last_anchor is not None and anchors[0] == last_anchor
            new = np.ones(len(rows), bool)
            new[1:] = anchors[1:] != anchors[:-1]
            group = np.cumsum(new) - 1
            # runs alone under their anchor repeat nothing; the last anchor may go on in the next batch
            many = np.bincount(group)[group] > 1
            many |= (group == group[-1]) | (goes_on & (group == 0))
            rows, group = rows[many], group[many]
            lengths = sizes[rows] // TAG_BYTES
            total = int(lengths.sum())
            run = np.repeat(np.arange(len(rows)), lengths)
            place = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            at = np.repeat(offsets[:-1][rows], lengths) + place * TAG_BYTES
            tags = np.zeros((total, 8), np.uint8)
            for b in range(TAG_BYTES):
                tags[:, b] = data[at + b]
            tags = tags.view(np.uint64).ravel()
            of = id_[rows][run]
            before = len(seen_tags) if goes_on else 0
            all_tags = np.concatenate([seen_tags[:before], tags])
            all_ids = np.concatenate([seen_ids[:before], of])
            all_groups = np.concatenate([np.zeros(before, np.int64), group[run]])
            order = np.lexsort((all_ids, all_tags, all_groups))
            t, g = all_tags[order], all_groups[order]
            head = np.ones(len(order), bool)
            head[1:] = (t[1:] != t[:-1]) | (g[1:] != g[:-1])
            smallest = all_ids[order][head][np.cumsum(head) - 1]
            later = np.empty(len(order), bool)
            later[order] = all_ids[order] > smallest
            of_last = head & (g == group[-1])
            last_anchor, seen_tags, seen_ids = anchor[rows[-1]], t[of_last], all_ids[order][of_last]
            hit = later[before:]
            if hit.any():
                begins = hit.copy()
                begins[1:] &= ~(hit[:-1] & (run[1:] == run[:-1]))
                ends = hit.copy()
                ends[:-1] &= ~(hit[1:] & (run[1:] == run[:-1]))
                a, b = np.flatnonzero(begins), np.flatnonzero(ends)
                at = rows[run[a]]
                yield span_rows(id_[at], tk[at], start[at], place[a], place[b])

    return spans


def _identity(id_col: str, text_col: str):
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), text_key(F.col(text_col))


def anchored_runs(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Runs of texts (id, tk, text) with the anchor under which they meet; those of hot anchors as single windows."""
    counts = in_arrow(texts, _anchor_counts_of(window, gram, STRETCH, OFTEN), "anchor long, times long")
    hot = (
        counts.groupBy("anchor")
        .agg(F.sum("times").alias("times"))
        .where(F.col("times") >= HOT_RUNS)
        .orderBy(F.desc("times"), "anchor")
        .limit(HOT)
        .toPandas()["anchor"]
        .to_numpy(np.int64)
    )
    return in_arrow(texts, _runs_of(window, gram, np.sort(hot)), RUNS)


def repeated_spans(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Word ranges (id, tk, first, last; counted from 0, overlapping) whose windows start in a smaller document too."""
    if not gram <= window <= gram + LONGEST_RUN - 1:
        raise ValueError(f"a window has {gram} to {gram + LONGEST_RUN - 1} words")
    id_, tk = _identity(id_col, text_col)
    texts = documents.where(F.col(text_col).isNotNull()).select(
        id_.alias("id"), tk.alias("tk"), F.col(text_col).cast("string").alias("text")
    )
    met = anchored_runs(texts, window, gram).repartition("anchor").sortWithinPartitions("anchor", "id")
    return in_arrow(met, _spans_of(window), SPANS)


def merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping or touching ranges as maximal ones, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(first.tolist(), last.tolist(), strict=True)):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _packed(batches):
    """Texts compressed, as they travel to their spans."""
    for batch in batches:
        data, offsets = hashing.text_buffers(batch.column("text"))
        for i, j in hashing.text_slices(offsets):
            part, sizes = batch.slice(i, j - i), np.diff(offsets[i : j + 1])
            texts = (data[offsets[n] : offsets[n + 1]] for n in range(i, j))
            packed = pa.array([pa.compress(t, CODEC, asbytes=True) if len(t) else b"" for t in texts], pa.binary())
            columns = [*(part.column(c) for c in ("doc_id", "id", "tk")), packed, pa.array(sizes)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "id", "tk", "packed", "size"])


def dedup_substrings(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (maximal repeats removed), kept (words left, by spaces).

    Words are compared exactly. A repeat inside one document, or between rows
    of the same id, is none; of equal passages the smallest id keeps its own. A
    null id comes after all others (two null ids are the same). Null, empty and
    blank texts have no words; texts shorter than a window keep all. Rows that
    repeat id and text get equal results. Other columns are not looked at.
    """
    spans = (
        repeated_spans(documents, id_col, text_col, window, gram)
        .groupBy("id", "tk")
        .agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))
        .withColumnsRenamed({"id": "s_id", "tk": "s_tk"})
    )
    id_, tk = _identity(id_col, text_col)
    kind = documents.schema[id_col].dataType
    texts = documents.select(
        F.col(id_col).alias("doc_id"), id_.alias("id"), tk.alias("tk"), F.col(text_col).cast("string").alias("text")
    )
    texts = in_arrow(texts, _packed, f"doc_id {kind.simpleString()}, id long, tk long, packed binary, size long")
    joined = texts.join(spans, (F.col("id") == F.col("s_id")) & (F.col("tk") == F.col("s_tk")), "left")

    def cut(batches):
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "packed", "size", "first", "last")]
            made, size = [], 0
            for doc_id, packed, whole, first, last in zip(*columns, strict=True):
                all_words = pa.decompress(packed.as_py(), whole.as_py(), CODEC, asbytes=True).split() if whole.as_py() else []
                ranges = merged(first.values.to_numpy(), last.values.to_numpy()) if first.is_valid else []
                kept, at = [], 0
                for a, b in ranges:
                    kept += all_words[at:a]
                    at = b + 1
                kept += all_words[at:]
                made.append((doc_id.as_py(), len(all_words), len(all_words) - len(kept), ranges, b" ".join(kept).decode()))
                size += len(made[-1][-1])
                if size > 8 << 20:
                    yield frame(made)
                    made, size = [], 0
            if made:
                yield frame(made)

    id_type = to_arrow_type(kind)
    spans_type = pa.list_(pa.struct([pa.field("first", pa.int64()), pa.field("last", pa.int64())]))

    def frame(made):
        doc_id, n_words, n_removed, ranges, kept = zip(*made, strict=True)
        rows = [[{"first": a, "last": b} for a, b in r] for r in ranges]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_id, id_type), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(rows, spans_type), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "spans", "kept"],
        )

    schema = f"doc_id {kind.simpleString()}, n_words long, n_removed long, spans array<struct<first:long,last:long>>, kept string"
    return in_arrow(joined.select("doc_id", "packed", "size", "first", "last"), cut, schema)
