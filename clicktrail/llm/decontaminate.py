"""Benchmark decontamination by SimHash windows.

Documents are cut into windows of the benchmark items' own sizes. A window and
an item are similar when their weighted 5-word shingles (weight: how often it
occurs) have a Jaccard similarity of 0.8 or more. Both get a 64-bit weighted
SimHash. A multi-index over eight 8-bit blocks finds every item within the
Hamming radius of a window: two fingerprints at most 7 bits apart agree in
some whole block. Similar pairs may lie beyond the radius, the more so where a
few shingles weigh much; so both are also indexed under the first of their sorted shingles, as many as
similar pairs must share one of (prefix filtering), which misses no pair.
Candidates of either index are then compared exactly.

Only windows that hold a shingle of some item of their size are cut; any other
has nothing in common with an item. Everything is DataFrame expressions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.common import broadcast_below, stored, text_key, words

SHINGLE = 5
#: Similarity, in hundredths.
SIMILAR = 80
BLOCKS, BLOCK_BITS = 8, 8
#: Bits; fewer than blocks, so that one block at least is whole.
RADIUS = 7
#: Item shingles (24 bytes each) up to which their table is broadcast.
BROADCAST_SHINGLES = 1_000_000
#: A window is coded as one long, its start above this many bits of its size; arrays of longs are told apart by hash.
SIZE_BITS = 32


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def shingle_hashes(word_list: Column, k: Column) -> Column:
    """Hashes of every k consecutive words, in order; none for fewer words."""
    last = F.size(word_list) - k + 1
    at = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(at, lambda i: F.xxhash64(F.slice(word_list, i, k)))


def simhash(hashes: Column) -> Column:
    """64-bit SimHash of a multiset of hashes (a column, not an expression): each bit is what more than half have.

    Sixteen sums hold four bits' counts each, in lanes of 16 bits; a multiset
    of more than 65,535 hashes is counted bit by bit instead. Every array is an
    argument of the next function, never named inside a lambda, so each is
    computed once.
    """
    n = F.size(hashes)
    shift = lambda value, by: F.call_function("shiftrightunsigned", value, by.cast("int"))

    def total(of) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda so_far, h: so_far + of(h))

    def nibble_lanes(j: Column) -> Column:
        def spread(h):
            nibble = shift(h, 4 * j).bitwiseAND(F.lit(15))
            return (nibble * F.lit(0x0000200040008001)).bitwiseAND(F.lit(0x0001000100010001))

        return total(spread)

    def four(lanes: Column) -> Column:
        return F.array(*[shift(lanes, F.lit(16 * lane)).bitwiseAND(F.lit(0xFFFF)) for lane in range(4)])

    def bit_total(b: Column) -> Column:
        return total(lambda h: shift(h, b).bitwiseAND(F.lit(1)))

    few = F.flatten(F.transform(F.transform(F.sequence(F.lit(0), F.lit(15)), nibble_lanes), four))
    many = F.transform(F.sequence(F.lit(0), F.lit(63)), bit_total)
    counts = F.when(n <= 0xFFFF, few).otherwise(many)
    bits = F.transform(counts, lambda c, b: F.call_function("shiftleft", (c * 2 > n).cast("long"), b))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda so_far, bit: so_far.bitwiseOR(bit))


def block(fingerprint: Column, at: Column) -> Column:
    moved = F.call_function("shiftrightunsigned", fingerprint, at * BLOCK_BITS)
    return moved.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def prefix(shingles: Column, similar: int) -> Column:
    """The distinct ones of so many first sorted shingles (repeats counted) that similar multisets share one."""
    n = F.size(shingles)
    return F.array_distinct(F.slice(F.sort_array(shingles), F.lit(1), n - F.ceil(n * similar / F.lit(100)).cast("int") + 1))


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Items with words, as item_id, n (words), k (words a shingle), shingles, fingerprint."""
    word_list = words(lowered(F.col(text_col)))
    k = F.least(F.lit(SHINGLE), F.col("n"))
    items = (
        benchmark.select(F.col(id_col).alias("item_id"), word_list.alias("words"))
        .withColumn("n", F.size("words"))
        .where("n > 0")
        .withColumn("k", k)
        .withColumn("shingles", shingle_hashes(F.col("words"), F.col("k")))
        .drop("words")
    )
    return stored(items.withColumn("fingerprint", simhash(F.col("shingles"))), "benchmark-items")


def _anchors(texts: DataFrame, items: DataFrame) -> DataFrame:
    """Per document, its places (pos from 1, k, sizes) with a shingle of an item, and those items' sizes."""
    by_shingle = items.select("n", "k", F.explode("shingles").alias("h"))
    sizes = stored(by_shingle.groupBy("h", "k").agg(F.collect_set("n").alias("sizes")), "benchmark-shingles")
    lengths = sorted(row.k for row in items.select("k").distinct().collect())
    n_sizes = sizes.count()

    def of_length(k: int) -> Column:
        place = lambda h, i: F.struct((i + 1).alias("pos"), F.lit(k).alias("k"), h.alias("h"))
        return F.transform(shingle_hashes(F.col("words"), F.lit(k)), place)

    places = F.flatten(F.array(*map(of_length, lengths)))
    if not lengths:
        places = F.expr("cast(array() as array<struct<pos:int,k:int,h:bigint>>)")
    found = (
        texts.select("id", "tk", words(lowered(F.col("text"))).alias("words"))
        .select("id", "tk", F.explode(places).alias("p"))
        .select("id", "tk", "p.pos", "p.k", "p.h")
        .join(broadcast_below(sizes, n_sizes, BROADCAST_SHINGLES), ["h", "k"])
    )
    return found.groupBy("id", "tk").agg(F.collect_set(F.struct("pos", "k", "sizes")).alias("anchors"))


def window_code(start: Column, n: Column) -> Column:
    return F.shiftleft(start.cast("long"), SIZE_BITS).bitwiseOR(n.cast("long"))


def window_of(code: Column) -> tuple[Column, Column]:
    return F.shiftright(code, SIZE_BITS).cast("int"), code.bitwiseAND(F.lit((1 << SIZE_BITS) - 1)).cast("int")


def _windows(texts: DataFrame, anchors: DataFrame) -> DataFrame:
    """Windows (id, tk, start from 1, n (the items' size), k, shingles, fingerprint) around the anchors of each document."""
    joined = texts.join(
        anchors.withColumnsRenamed({"id": "a_id", "tk": "a_tk"}),
        F.col("id").eqNullSafe(F.col("a_id")) & (F.col("tk") == F.col("a_tk")),
    ).select("id", "tk", words(lowered(F.col("text"))).alias("words"), "anchors")
    n_words = F.size("words")

    def around(anchor):
        def of_size(n):
            first = F.greatest(anchor["pos"] - (n - anchor["k"]), F.lit(1))
            last = F.least(anchor["pos"], F.greatest(n_words - n + 1, F.lit(1)))
            starts = F.when(first <= last, F.sequence(first, last)).otherwise(F.expr("cast(array() as array<int>)"))
            return F.transform(starts, lambda s: window_code(s, n))

        return F.flatten(F.transform(anchor["sizes"], of_size))

    codes = F.array_distinct(F.flatten(F.transform("anchors", around)))
    start, size = window_of(F.col("code"))
    cut = (
        joined.select("id", "tk", "words", F.explode(codes).alias("code"))
        .select("id", "tk", start.alias("start"), size.alias("n"), F.slice(F.col("words"), start, size).alias("part"))
        .withColumn("k", F.least(F.lit(SHINGLE), F.col("n")))
        .withColumn("shingles", shingle_hashes(F.col("part"), F.col("k")))
        .where(F.size("shingles") > 0)
        .withColumn("words", F.size("part"))
        .drop("part")
    )
    return cut.withColumn("fingerprint", simhash(F.col("shingles")))


def _shared(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two arrays."""
    count = lambda array, x: F.size(F.filter(array, lambda y: y == x))
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    counted = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda total, x: total + F.least(count(a, x), count(b, x))
    )
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted)


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similar: int = SIMILAR,
) -> DataFrame:
    """One row per document and item it contains: doc_id, tk (its text's key), item_id, similarity, start, n_words, n_windows.

    ``start`` (word, from 0) and ``n_words`` tell the most similar window, the
    first of equals; ``n_windows`` counts all similar ones. Words are compared
    lower-cased in A-Z. A document shorter than an item is one window. Items
    with fewer words than a shingle match as a whole; items and documents that
    are null, empty or blank match nothing. Rows that repeat id and text give
    one row. Items of equal text are found each. An empty table gives no rows.
    """
    texts = documents.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), F.col(text_col).cast("string").alias("text")
    )
    items = benchmark_items(benchmark, item_col, item_text_col)
    windows = _windows(texts, _anchors(texts, items))
    at = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    blocks = lambda fingerprint: F.transform(
        at, lambda i: F.struct(i.alias("block"), block(fingerprint, i).alias("value"))
    )
    # the prefix's shingles follow as values of one block more
    firsts = lambda h: F.struct(F.lit(BLOCKS).alias("block"), h.alias("value"))
    values = lambda: F.concat(blocks(F.col("fingerprint")), F.transform("prefix", firsts))
    windows = windows.withColumn("prefix", prefix(F.col("shingles"), similar))
    probes = windows.withColumn("b", F.explode(values())).select(
        "id", "tk", "start", "n", "words", "shingles", "fingerprint", "prefix", "b.block", "b.value"
    )
    index = (
        items.withColumn("prefix", prefix(F.col("shingles"), similar))
        .withColumn("b", F.explode(values()))
        .select(
            "item_id",
            F.col("n").alias("i_n"),
            F.col("shingles").alias("i_shingles"),
            F.col("fingerprint").alias("i_fingerprint"),
            F.col("prefix").alias("i_prefix"),
            F.col("b.block").alias("i_block"),
            F.col("b.value").alias("i_value"),
        )
    )
    met = probes.join(
        index, (F.col("n") == F.col("i_n")) & (F.col("block") == F.col("i_block")) & (F.col("value") == F.col("i_value"))
    )
    apart = F.col("fingerprint").bitwiseXOR(F.col("i_fingerprint"))
    near = F.bit_count(apart) <= RADIUS
    earlier = F.exists(at, lambda i: (i < F.col("block")) & (block(apart, i) == 0))
    first = F.col("value") == F.array_min(F.array_intersect("prefix", "i_prefix"))
    # in one expression, so that the costly part is computed once, and only behind the cheap one
    candidate = F.when(F.col("block") < BLOCKS, near & ~earlier).otherwise(~near & first)
    shared = F.when(candidate, _shared(F.col("shingles"), F.col("i_shingles")))
    score = F.struct(shared.alias("shared"), (F.size("shingles") + F.size("i_shingles")).alias("both"))
    enough = lambda s: 100 * s["shared"] >= similar * (s["both"] - s["shared"])
    close = met.select(
        "id", "tk", "start", "words", "item_id", F.explode(F.filter(F.array(score), enough)).alias("score")
    ).withColumn("similarity", F.col("score.shared") / (F.col("score.both") - F.col("score.shared")))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "words")).alias("best")
    return (
        close.groupBy("id", "tk", "item_id")
        .agg(best, F.size(F.collect_set("start")).cast("long").alias("n_windows"))
        .select(
            F.col("id").alias("doc_id"),
            "tk",
            "item_id",
            "best.similarity",
            (-F.col("best.s") - 1).cast("long").alias("start"),
            F.col("best.words").cast("long").alias("n_words"),
            "n_windows",
        )
    )
