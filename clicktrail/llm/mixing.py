"""Mixing sources to target weights.

Every document gets a hash-random key. Within each source the documents are
range-sorted by that key: the key space of a source is cut into equal ranges
(keys are uniform, so ranges hold equally many documents however large one
source is), token counts are summed per range, the range totals are
prefix-summed in two levels, and each range is prefix-summed on its own. Rows
equal in id, text and source are one row with a count up to there. A source is
cut at exactly its budget; a budget above the source's size repeats whole
epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm.common import WORD, broadcast_below, stored

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
ROWS_PER_RANGE = 2_000
#: Ranges whose totals are prefix-summed in one window.
RANGES_PER_SPAN = 10_000
#: Copies of a row written out of one array.
COPIES = 4_096
SEED = "mix"
#: Keys are the first 15 hexadecimal digits of an MD5 sum.
KEY_SPACE = float(1 << 60)
#: Sources (one row each) up to which their table is broadcast.
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixing_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    identity = F.concat_ws(
        "\x1f", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(F.md5(text), F.lit(""))
    )
    return F.conv(F.substring(F.md5(identity), 1, 15), 16, 10).cast("long")


def source_budgets(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> tuple[DataFrame, int]:
    """Per source: docs, source_size, weight, target and budget; and the number of sources.

    Sources in code-point order, null last, take the weights in turn. A target
    is the source's share of all tokens; one above ``max_epochs`` times its
    source stops there and the rest is shared again. Each round only needs two
    sums over the source table, so the rounds run as small aggregates.
    """
    per_source = sized.groupBy("source").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size")
    )
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    table = stored(
        per_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long")),
        "mix-sources",
    )
    cap = F.col("source_size") * max_epochs
    total, weight_sum, sources = table.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0)), F.count(F.lit(1))
    ).first()
    free, capped = total, 0

    def above(free: int, weight_sum: int) -> Column:
        return cap * F.lit(weight_sum) < F.lit(free) * F.col("weight")

    while weight_sum:
        over = above(free, weight_sum)
        fixed, left, now = table.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(over.cast("long")), F.lit(0)),
        ).first()
        if now == capped:
            break
        free, weight_sum, capped = total - fixed, left, now
    if not weight_sum:
        return table.withColumns({"target": cap.cast("double"), "budget": cap}), sources
    share = F.lit(free) * F.col("weight")
    over = above(free, weight_sum)
    return table.withColumns(
        {
            "target": F.when(over, cap.cast("double")).otherwise(share.cast("double") / F.lit(float(weight_sum))),
            "budget": F.when(over, cap).otherwise(F.floor(F.expr(f"({free}L * weight) div {weight_sum}L"))),
        }
    ), sources


def earlier_sum(value: str, keys: list[str], order: list[str]) -> Column:
    """The sum over the rows before this one, 0 for the first."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0)).cast("long")


def mixed_groups(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    rows_per_range: int = ROWS_PER_RANGE,
    seed: str = SEED,
    ranges_per_span: int = RANGES_PER_SPAN,
) -> DataFrame:
    """One row per (doc_id, text_key, source): size, source_size, target, budget, copies and at.

    ``copies`` rows are equal in all three; their words follow each other, the
    first copy's after ``at`` others of the source.
    """
    doc_id, text = F.col(id_col), F.col(text_col)
    sized = stored(
        documents.select(
            doc_id.alias("doc_id"),
            F.xxhash64(F.coalesce(text, F.lit("")), text.isNull()).alias("text_key"),
            F.col(source_col).alias("source"),
            word_count(text).alias("size"),
            mixing_key(doc_id, text, seed).alias("key"),
        ),
        "mix-sizes",
    )
    sources, n_sources = source_budgets(sized, weights, max_epochs)
    budgets = broadcast_below(
        sources.withColumnRenamed("source", "of_source"), n_sources, BROADCAST_SOURCES
    )
    one = sized.groupBy("doc_id", "text_key", "source", "size", "key").agg(F.count(F.lit(1)).alias("copies"))
    ranges = F.ceil(F.col("docs") / F.lit(rows_per_range))
    keyed = one.join(budgets, F.col("source").eqNullSafe(F.col("of_source"))).withColumns(
        {"range": F.floor(F.col("key") / F.lit(KEY_SPACE) * ranges), "words": F.col("size") * F.col("copies")}
    )
    totals = keyed.groupBy("of_source", "range").agg(F.sum("words").alias("range_size"))
    totals = totals.withColumn("span", F.floor(F.col("range") / F.lit(ranges_per_span)))
    spans = totals.groupBy("of_source", "span").agg(F.sum("range_size").alias("span_size"))
    spans = spans.select(
        F.col("of_source").alias("s_source"), F.col("span").alias("s_span"), earlier_sum("span_size", ["of_source"], ["span"]).alias("before")
    )
    offsets = totals.join(
        spans, F.col("of_source").eqNullSafe(F.col("s_source")) & (F.col("span") == F.col("s_span"))
    ).select(
        F.col("of_source").alias("o_source"),
        F.col("range").alias("o_range"),
        (F.col("before") + earlier_sum("range_size", ["of_source", "span"], ["range"])).alias("offset"),
    )
    inner = earlier_sum("words", ["of_source", "range"], ["key", "doc_id", "text_key"])
    placed = keyed.withColumn("inner", inner).join(
        offsets, F.col("of_source").eqNullSafe(F.col("o_source")) & (F.col("range") == F.col("o_range"))
    )
    return placed.select(
        "doc_id", "text_key", "source", "size", "source_size", "target", "budget", "copies",
        (F.col("offset") + F.col("inner")).alias("at"),
    )


def shared_out(groups: DataFrame) -> DataFrame:
    """Rows with copies and at (their other columns kept) as one row a copy: epochs, rest and taken of each.

    Of a group's copies the first are taken whole, the one at the cut in part,
    and the others not in this epoch. They are written out in steps, so that no
    array holds them all.
    """
    size, whole, copies = F.col("size"), F.greatest(F.col("source_size"), F.lit(1)), F.col("copies")
    none = F.lit(0).cast("long")
    left = F.greatest(none, F.col("budget") - F.col("epochs") * whole - F.col("at"))
    full = F.when(size > 0, F.least(copies, F.expr("_left div size"))).otherwise(none)
    share = lambda n, rest: F.struct(n.cast("long").alias("n"), rest.cast("long").alias("rest"))
    shares = F.array(
        share(F.col("_full"), size),
        share(F.least(F.lit(1), copies - F.col("_full")), F.least(size, F.col("_left") - F.col("_full") * size)),
        share(copies - F.col("_full") - 1, none),
    )
    kept = [c for c in groups.columns if c not in ("copies", "at", "budget")]
    parts = (
        groups.withColumn("epochs", F.floor(F.col("budget") / whole))
        .withColumn("_left", left)
        .withColumn("_full", full)
        .withColumn("_share", F.explode(F.filter(shares, lambda s: s["n"] > 0)))
        .select(*kept, "epochs", "_share")
    )
    steps = F.sequence(none, F.floor((F.col("_share.n") - 1) / COPIES))
    inside = F.least(F.lit(COPIES).cast("long"), F.col("_share.n") - F.col("_step") * COPIES)
    return (
        parts.withColumn("_step", F.explode(steps))
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(True), inside.cast("int"))))
        .withColumn("rest", F.col("_share.rest"))
        .withColumn("taken", (F.col("epochs") * size + F.col("rest")).cast("long"))
        .select(*kept, "taken", "epochs", "rest")
    )


def mix(documents: DataFrame, **parameters) -> DataFrame:
    """One row per document: doc_id, text_key, source, size, source_size, target, taken, epochs, rest.

    Parameters are those of :func:`mixed_groups`. ``taken`` words are ``epochs``
    whole passes over the document and ``rest`` words of it. Null texts have
    size 0 and give nothing; a null source is a source; documents repeated with
    the same id, text and source sort next to each other and are counted each,
    whatever share of the table they are; other columns are not looked at. An
    empty table gives no rows. The result depends on ids and texts only, so
    reruns agree.
    """
    out = shared_out(mixed_groups(documents, **parameters))
    return out.select("doc_id", "text_key", "source", "size", "source_size", "target", "taken", "epochs", "rest")
