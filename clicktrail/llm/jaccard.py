"""N-gram Jaccard join with signature trees.

Documents are sets of 5-word shingles; two link when their Jaccard similarity
is at least 0.8. The join is exact:

1. Equal sets collapse to one; only different sets are compared.
2. Shingles are ordered, the frequent ones last, and a set sends only as many
   of its first ones as sets that are similar enough must share (prefix
   filtering). Sets that share none cannot link.
3. Sets that meet under a shingle go into a signature tree: leaves hold
   documents, nodes the OR of their token bitmaps and their size range. A dual
   traversal of the tree with itself drops pairs of nodes whose largest possible
   overlap is too small. What survives is joined to candidate groups.
4. Each candidate group is traversed again, with the documents' whole sets at
   the leaves; pairs already connected are skipped, all others are compared
   exactly. Large groups are cut into blocks and block pairs, so no task holds
   more than two blocks.
5. The links' connected components are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm import hashing
from clicktrail.llm.common import in_arrow, stored, text_key
from clicktrail.llm.components import connected_components

SHINGLE = 5
#: Similarity, in hundredths.
SIMILAR = 80
#: A bitmap has two to four bits for each token, and at least and at most so many.
LEAST_BITS, MOST_BITS = 256, 1 << 20
#: Bytes of bitmaps that are compared at once.
AT_ONCE = 32 << 20
LEAF, FANOUT = 16, 8
#: Sets in one block of a signature tree with bitmaps, and with whole sets.
BITMAP_BLOCK, EXACT_BLOCK = 1_024, 512
#: Frequent shingles that sort last: at most so many, seen in so many sets of one run of tokens at least.
FREQUENT, FREQUENT_IN_RUN, RUN_TOKENS = 1 << 17, 3, 4_000_000

SETS = "id long, no_id boolean, tk long, n long, set long, check long, bits binary, token long, times long"
U = np.uint64


# --- sets, signatures and frequent shingles ------------------------------------


def set_hashes(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set of tokens."""
    if not len(tokens):
        return 0, 0
    one = hashing.mixed(tokens * U(0xD6E8FEB86659FD93) + U(1)).sum(dtype=U)
    two = np.bitwise_xor.reduce(hashing.mixed(tokens ^ U(0xA0761D6478BD642F)))
    return tuple(hashing.mixed(np.array([one, two + U(len(tokens))], U)).view(np.int64).tolist())


def signature(tokens: np.ndarray) -> bytes:
    width = min(max(LEAST_BITS, 1 << (2 * len(tokens)).bit_length()), MOST_BITS)
    bits = np.zeros(width, bool)
    bits[(tokens & U(width - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _frequent(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    values, times = np.unique(np.concatenate(tokens), return_counts=True) if tokens else (np.zeros(0, U), np.zeros(0, int))
    often = times >= FREQUENT_IN_RUN
    return values[often], times[often]


def _sets_of(shingle: int):
    def sets(batches):
        tokens, held = [], 0
        for batch in batches:
            rows = []
            for s in hashing.shingle_sets(batch.column("text"), shingle, lower=True):
                rows.append((len(s), *set_hashes(s), signature(s)))
                tokens.append(s)
                held += len(s)
            n, one, two, bits = zip(*rows, strict=True) if rows else ((), (), (), ())
            none = pa.nulls(len(rows), pa.int64())
            columns = [
                batch.column("id"), batch.column("no_id"), batch.column("tk"), pa.array(n, pa.int64()),
                pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(bits, pa.binary()), none, none,
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_names(SETS))
            if held >= RUN_TOKENS:
                yield frequent_rows(tokens)
                tokens, held = [], 0
        yield frequent_rows(tokens)

    def frequent_rows(tokens):
        values, times = _frequent(tokens)
        none = pa.nulls(len(values), pa.int64())
        columns = [
            none, pa.nulls(len(values), pa.bool_()), none, none, none, none, pa.nulls(len(values), pa.binary()),
            hashing.long_column(values), hashing.long_column(times),
        ]
        return pa.RecordBatch.from_arrays(columns, names=_names(SETS))

    return sets


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


# --- prefixes --------------------------------------------------------------------


def prefix_length(n: int, similar: int) -> int:
    """How many of its first tokens a set of n shows, so that similar sets share one: n - ceil(n * similar) + 1."""
    return n - -(-n * similar // 100) + 1


def _prefixes_of(shingle: int, similar: int, frequent: np.ndarray, rank: np.ndarray):
    """``frequent`` is sorted; ``rank`` says how common each of them is."""

    def prefixes(batches):
        for batch in batches:
            tokens, owners, held = [], [], 0
            for s in hashing.shingle_sets(batch.column("text"), shingle, lower=True):
                if not len(s):
                    continue
                take = prefix_length(len(s), similar)
                first = s[:take]
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    common = frequent[at] == s
                    if common.any():
                        late = np.flatnonzero(common)
                        late = late[np.lexsort((s[late], rank[at[late]]))]
                        first = s[np.append(np.flatnonzero(~common), late)[:take]]
                tokens.append(first)
                owners.append(np.full(take, set_hashes(s)[0], np.int64))
                held += take
                if held >= 1 << 17:
                    yield rows(tokens, owners)
                    tokens, owners, held = [], [], 0
            if held:
                yield rows(tokens, owners)

    def rows(tokens, owners):
        columns = [hashing.long_column(np.concatenate(tokens)), pa.array(np.concatenate(owners))]
        return pa.RecordBatch.from_arrays(columns, names=["token", "set"])

    return prefixes


def _shared(batches):
    """Of rows sorted by (token, set): those whose token has several sets, once each."""
    token, owner, sent = None, None, False
    for batch in batches:
        t, s = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(t):
            continue
        if token is not None:
            t, s = np.append(token, t), np.append(owner, s)
        fresh = np.ones(len(t), bool)
        fresh[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
        t, s = t[fresh], s[fresh]
        before = np.zeros(len(t), bool)
        before[1:] = t[1:] == t[:-1]
        after = np.zeros(len(t), bool)
        after[:-1] = before[1:]
        keep = before | after
        # the row carried over from the last batch was sent there or is alone so far
        first_sent = sent
        token, owner, sent = t[-1], s[-1], bool(before[-1]) or (len(t) == 1 and first_sent)
        if first_sent:
            if len(t) > 1 and t[1] == t[0]:
                keep[1] = True
            keep[0] = False
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(t[keep]), pa.array(s[keep])], names=["token", "set"])


# --- signature trees ---------------------------------------------------------------


class Forest:
    """Union-find over the members of one unit."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.parent[y] = x
        return x != y


def _popcount(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=-1, dtype=np.int64)


def tree(bits: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Levels from the leaves up, over documents in the given order: (OR of bitmaps, fewest bits, least and greatest size)."""
    levels = []
    step = LEAF
    level = (bits, _popcount(bits), sizes, sizes)
    while True:
        at = np.arange(0, len(level[0]), step)
        level = (
            np.bitwise_or.reduceat(level[0], at, axis=0), np.minimum.reduceat(level[1], at),
            np.minimum.reduceat(level[2], at), np.maximum.reduceat(level[3], at),
        )
        levels.append(level)
        if len(at) == 1:
            return levels
        step = FANOUT


def _possible(u, v, i: np.ndarray, j: np.ndarray, similar: int) -> np.ndarray:
    """Whether any document under node i of u and any under node j of v may be similar enough.

    A document under u has at least ``fewest`` bits, of which only those that
    v has too can belong to an overlap; the others are tokens it does not share.
    """
    both = _popcount(u[0][i] & v[0][j])
    lost_u, lost_v = np.maximum(u[1][i] - both, 0), np.maximum(v[1][j] - both, 0)
    overlap = np.minimum(u[3][i] - lost_u, v[3][j] - lost_v)
    ratio = (100 * u[3][i] >= similar * v[2][j]) & (100 * v[3][j] >= similar * u[2][i])
    return ratio & ((100 + similar) * overlap >= similar * (u[2][i] + v[2][j]))


def dual_traversal(bits: list[bytes], sizes, side, similar: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of documents (x, y, bound on their overlap) that no node pair above them rules out.

    With two sides, only pairs across are wanted. There is one tree for each
    width of bitmaps; similar sets differ by one width at most, so neighbouring
    widths are traversed too, the wider bitmaps folded.
    """
    width = np.array([len(b) for b in bits])
    two_sided = len(side) and (side != side[0]).any()
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        level = np.frombuffer(b"".join(bits[m] for m in own), np.uint8).reshape(len(own), w)
        wider = np.flatnonzero(width == 2 * w)
        yield from _traversed(level, own, sizes, side if two_sided else None, similar)
        if len(wider):
            folded = np.frombuffer(b"".join(bits[m] for m in wider), np.uint8).reshape(len(wider), 2, w)
            both = np.concatenate([level, folded[:, 0] | folded[:, 1]])
            yield from _traversed(both, np.append(own, wider), sizes, side if two_sided else None, similar, width)


def _traversed(level, members, sizes, side, similar: int, width=None):
    """A traversal of one tree: pairs of ``members``, across sides and across widths if given."""
    bits, sizes = np.ascontiguousarray(level).view(U), sizes[members]
    order = np.lexsort((bits[:, 1], bits[:, 0], sizes))
    bits, sizes, members = bits[order], sizes[order], members[order]
    levels = tree(bits, sizes)
    i = j = np.zeros(1, np.int64)
    pairs_at_once = max(LEAF * LEAF, AT_ONCE // (bits.shape[1] * 8))
    for depth in range(len(levels) - 1, -1, -1):
        keep = np.zeros(len(i), bool)
        for a in range(0, len(i), pairs_at_once):
            part = slice(a, a + pairs_at_once)
            keep[part] = _possible(levels[depth], levels[depth], i[part], j[part], similar)
        i, j = i[keep], j[keep]
        if not len(i):
            return
        if depth:
            i, j = _children(i, j, FANOUT, len(levels[depth - 1][0]))
    ones = _popcount(bits)
    leaves_at_once = pairs_at_once // (LEAF * LEAF)
    for a in range(0, len(i), leaves_at_once):
        x, y = _children(i[a : a + leaves_at_once], j[a : a + leaves_at_once], LEAF, len(bits), distinct=True)
        for values in (side, width):
            if values is not None:
                across = values[members[x]] != values[members[y]]
                x, y = x[across], y[across]
        both = _popcount(bits[x] & bits[y])
        overlap = np.minimum(sizes[x] - (ones[x] - both), sizes[y] - (ones[y] - both))
        keep = (100 + similar) * overlap >= similar * (sizes[x] + sizes[y])
        yield members[x[keep]], members[y[keep]], overlap[keep]


def _children(i, j, width: int, below: int, distinct: bool = False):
    """All pairs of the children of node pairs, each once (i <= j, or i < j)."""
    kids = np.arange(width)
    x = (i[:, None, None] * width + kids[None, :, None]).repeat(width, axis=2).ravel()
    y = (j[:, None, None] * width + kids[None, None, :]).repeat(width, axis=1).ravel()
    keep = (x < below) & (y < below) & ((x < y) if distinct else (x <= y))
    return x[keep], y[keep]


# --- units: the sets of one group, or of two of its blocks -----------------------------


def in_units(rows: DataFrame, group: str, member: str, count: str, block: int) -> DataFrame:
    """Rows with ``part`` and the unit (group, pa, pb) they belong to; groups above a block go into pairs of blocks."""
    parts = F.ceil(F.col(count) / F.lit(block)).cast("long")
    mine = F.pmod(F.xxhash64(member), F.col("parts"))
    return (
        rows.withColumn("parts", parts)
        .withColumn("part", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .withColumns({"pa": F.least("part", "other"), "pb": F.greatest("part", "other")})
        .drop("other", "parts")
        .repartition(group, "pa", "pb")
        .sortWithinPartitions(group, "pa", "pb")
    )


def _unit_batches(batches, names: list[str]) -> Iterator[dict]:
    """Columns of one unit after another, out of batches sorted by the first three columns."""
    held: list[dict] = []

    def joined(parts):
        return {c: [x for p in parts for x in p[c]] if isinstance(parts[0][c], list) else np.concatenate([p[c] for p in parts]) for c in names}

    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {}
        for c in names:
            column = batch.column(c)
            columns[c] = column.to_pylist() if pa.types.is_binary(column.type) else column.to_numpy(zero_copy_only=False)
        keys = np.stack([columns[c] for c in names[:3]], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            now = tuple(keys[a])
            if held and now != key:
                yield joined(held)
                held = []
            key = now
            held.append({c: v[a:b] for c, v in columns.items()})
    if held:
        yield joined(held)


def _edge_batch(a, b):
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _candidates_of(similar: int):
    """Per unit, a spanning forest of the pairs that their bitmaps allow."""

    def candidates(batches):
        a, b = [], []
        for unit in _unit_batches(batches, ["token", "pa", "pb", "part", "set", "n", "bits"]):
            sets, side = unit["set"], unit["part"]
            if unit["pa"][0] == unit["pb"][0]:
                side = np.zeros(len(sets), np.int64)
            forest = Forest(len(sets))
            for x, y, _ in dual_traversal(unit["bits"], unit["n"], side, similar):
                for p, q in zip(x.tolist(), y.tolist(), strict=True):
                    if forest.union(p, q):
                        a.append(int(sets[p]))
                        b.append(int(sets[q]))
            if len(a) >= 1 << 15:
                yield _edge_batch(a, b)
                a, b = [], []
        yield _edge_batch(a, b)

    return candidates


def _links_of(similar: int):
    """Per unit, a spanning forest of its links: sets are compared exactly unless they are connected already."""

    def links(batches):
        a, b = [], []
        for unit in _unit_batches(batches, ["component", "pa", "pb", "part", "set", "n", "bits", "tokens"]):
            sets, side = unit["set"], unit["part"]
            if unit["pa"][0] == unit["pb"][0]:
                side = np.zeros(len(sets), np.int64)
            tokens = [np.frombuffer(t, U) for t in unit["tokens"]]
            forest = Forest(len(sets))
            found = list(dual_traversal(unit["bits"], unit["n"], side, similar))
            if not found:
                continue
            x, y, overlap = (np.concatenate(c) for c in zip(*found, strict=True))
            likely = np.argsort(-(overlap / (unit["n"][x] + unit["n"][y] - overlap)), kind="stable")
            for p, q in zip(x[likely].tolist(), y[likely].tolist(), strict=True):
                if forest.find(p) == forest.find(q):
                    continue
                both = len(np.intersect1d(tokens[p], tokens[q], assume_unique=True))
                if 100 * both >= similar * (len(tokens[p]) + len(tokens[q]) - both):
                    forest.union(p, q)
                    a.append(int(sets[p]))
                    b.append(int(sets[q]))
            if len(a) >= 1 << 15:
                yield _edge_batch(a, b)
                a, b = [], []
        yield _edge_batch(a, b)

    return links


def _tokens_of(shingle: int):
    def tokens(batches):
        for batch in batches:
            made, size, begin = [], 0, 0
            for n, s in enumerate(hashing.shingle_sets(batch.column("text"), shingle, lower=True), 1):
                made.append(s.tobytes())
                size += len(made[-1])
                if size > 8 << 20 or n == batch.num_rows:
                    part = batch.slice(begin, n - begin)
                    columns = [part.column(c) for c in batch.schema.names if c != "text"]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(made, pa.binary())], names=[*(c for c in batch.schema.names if c != "text"), "tokens"]
                    )
                    made, size, begin = [], 0, n

    return tokens


# --- the join -----------------------------------------------------------------------------


def jaccard_components(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similar: int = SIMILAR
) -> DataFrame:
    """One row per document: doc_id, tk (its text's key), n_shingles, component_id.

    Documents link when 100 * intersection >= ``similar`` * union. The
    component's id is the smallest doc_id in it. Texts are lower-cased in A-Z
    only; a text with fewer words than a shingle is one shingle; null, empty and
    blank texts have none, link with nothing and are their own component. A
    null doc_id never is the smallest unless all are null. Rows that repeat an
    id, equal or not, are documents of their own; so components may share a
    component_id, and only ``jaccard_classes`` tells them apart. Set identity is
    128 bits of hash, meeting in the join is on 64. ``similar`` is at least 50:
    below, bitmaps of more than two widths would have to be compared.
    """
    return jaccard_classes(documents, id_col, text_col, shingle, similar).drop("leads")


def jaccard_classes(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similar: int = SIMILAR
) -> DataFrame:
    """``jaccard_components`` with ``leads``: whether the row has the smallest (id, tk) of its component, nulls last.

    Every component has one such (id, tk), on one or several equal rows, and no
    two components have the same. Rows without shingles all lead.
    """
    if not 50 <= similar <= 100:
        raise ValueError(f"similarity of 50 to 100 hundredths, not {similar}")
    texts = documents.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(id_col).isNull().alias("no_id"),
        text_key(F.col(text_col)).alias("tk"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    table = stored(in_arrow(texts, _sets_of(shingle), SETS), "jaccard-sets")
    rows = table.where("token is null").drop("token", "times")
    common = (
        table.where("token is not null")
        .groupBy("token")
        .agg(F.sum("times").alias("times"))
        .orderBy(F.desc("times"), "token")
        .limit(FREQUENT)
        .toPandas()
    )
    frequent, rank = common["token"].to_numpy(np.int64).view(U), common["times"].to_numpy(np.int64)
    order = np.argsort(frequent)

    place = F.struct("no_id", "id", "tk")
    sets = stored(
        rows.where("n > 0")
        .groupBy("set", "check")
        .agg(F.min(place).alias("first"), F.max("n").alias("n"), F.max("bits").alias("bits")),
        "jaccard-distinct",
    )
    prefixes = in_arrow(
        texts.select("text"), _prefixes_of(shingle, similar, frequent[order], rank[order]), "token long, set long"
    )
    by_token = prefixes.repartition("token").sortWithinPartitions("token", "set")
    shared = stored(in_arrow(by_token, _shared, "token long, set long"), "jaccard-shared")
    # shingles under which the same sets meet give the same tree: one of them is enough
    groups = shared.groupBy("token").agg(
        F.bit_xor(F.xxhash64("set")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "set")).alias("y"), F.count(F.lit(1)).alias("count")
    )
    groups = groups.groupBy("x", "y", "count").agg(F.min("token").alias("token")).select("token", "count")
    meeting = shared.join(groups, "token").join(sets.select("set", "n", "bits"), "set")
    candidates = in_units(meeting, "token", "set", "count", BITMAP_BLOCK).select(
        "token", "pa", "pb", "part", "set", "n", "bits"
    )
    coarse = stored(
        connected_components(in_arrow(candidates, _candidates_of(similar), "a long, b long")).withColumnRenamed("node", "set"),
        "jaccard-candidates",
    )
    counts = coarse.groupBy("component").agg(F.count(F.lit(1)).alias("count"))
    members = coarse.join(counts, "component").join(sets, "set")
    members = members.select(
        "component", "count", "set", "n", "bits",
        F.col("first.no_id").alias("m_no_id"), F.col("first.id").alias("m_id"), F.col("first.tk").alias("m_tk"),
    )
    at = F.col("id").eqNullSafe(F.col("m_id")) & (F.col("tk") == F.col("m_tk"))
    # rows that repeat id and text bring a set once each; one is enough, and copies go before they are shuffled
    once = texts.join(members, at).groupBy("set").agg(*[F.first(c).alias(c) for c in ("component", "count", "n", "bits", "text")])
    whole = in_arrow(
        once.select("component", "count", "set", "n", "bits", "text"),
        _tokens_of(shingle),
        "component long, count long, set long, n long, bits binary, tokens binary",
    )
    exact = in_units(whole, "component", "set", "count", EXACT_BLOCK).select(
        "component", "pa", "pb", "part", "set", "n", "bits", "tokens"
    )
    linked = connected_components(in_arrow(exact, _links_of(similar), "a long, b long"))
    labelled = (
        sets.select("set", "check", "first")
        .join(linked.withColumnRenamed("node", "set"), "set", "left")
        .withColumn("component", F.coalesce("component", "set"))
    )
    smallest = labelled.groupBy("component").agg(F.min("first").alias("least"))
    classes = labelled.join(smallest, "component").select(
        F.col("set").alias("c_set"), F.col("check").alias("c_check"), "least"
    )
    joined = rows.join(classes, (F.col("set") == F.col("c_set")) & (F.col("check") == F.col("c_check")), "left")
    leads = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("tk") == F.col("least.tk"))
    return joined.select(
        F.col("id").alias("doc_id"),
        "tk",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("least.id")).alias("component_id"),
        ((F.col("n") == 0) | leads).alias("leads"),
    )
