"""Line dedup over overlapping windows of consecutive lines.

Each window of three consecutive lines is hashed (128 bits). The first
occurrence of a window, by document id and position, stays; lines covered by
any later occurrence go, overlapping windows of a document being merged into
runs before its text is rebuilt from the gaps between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm.common import stored, text_key

WINDOW = 3


def covered_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Runs of lines to remove, per (id, text_key): an array of (first, last), counted from 1 and in order."""
    lines = documents.select(
        F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), F.split(F.col(text_col), "\n").alias("lines")
    ).where(F.size("lines") >= window)

    def one(at):
        part = F.slice(F.col("lines"), at, window)
        blank = F.forall(part, lambda line: F.trim(line) == "")
        return F.when(~blank, F.struct(at.alias("pos"), F.xxhash64(part).alias("h1"), F.xxhash64(F.lit(1), part).alias("h2")))

    starts = F.sequence(F.lit(1), F.size("lines") - window + 1)
    windows = stored(
        lines.select("id", "tk", F.explode(F.filter(F.transform(starts, one), lambda x: x.isNotNull())).alias("w")).select(
            "id", "tk", "w.pos", "w.h1", "w.h2"
        ),
        "line-windows",
    )
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "tk", "pos")
    firsts = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") != F.col("last"))
        .drop("last")
    )
    later = windows.join(firsts, ["h1", "h2"]).where(place != F.col("first")).select("id", "tk", "pos").distinct()
    by_document = Window.partitionBy("id", "tk").orderBy("pos")
    starts_run = (F.col("pos") - F.lag("pos", 1, -window).over(by_document) > window).cast("int")
    runs = (
        later.withColumn("new", starts_run)
        .withColumn("run", F.sum("new").over(by_document))
        .groupBy("id", "tk", "run")
        .agg(F.min("pos").alias("first"), (F.max("pos") + window - 1).alias("last"))
    )
    return runs.groupBy("id", "tk").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))


def dedup_lines(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per document: ``doc`` (its columns, text unchanged), n_lines, n_removed, kept (the text that is left).

    Windows compare lines exactly; windows of blank lines only do not count.
    Documents with fewer lines than a window, and null texts, keep everything
    (null stays null, with no lines). A null id sorts after all others. Rows
    that repeat id and text are one occurrence and get the same result. A
    document of which nothing is left has an empty text.
    """
    doc = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc"),
        F.col(id_col).alias("id"),
        text_key(F.col(text_col)).alias("tk"),
    )
    runs = covered_runs(documents, id_col, text_col, window).select(
        F.col("id").alias("r_id"), F.col("tk").alias("r_tk"), "runs"
    )
    joined = doc.join(runs, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("tk") == F.col("r_tk")), "left")
    joined = joined.withColumn("lines", F.split(F.col(f"doc.`{text_col}`"), "\n"))

    def gap(at):
        begin = F.when(at == 0, 1).otherwise(F.col("runs")[at - 1]["last"] + 1)
        end = F.when(at == F.size("runs"), F.size("lines")).otherwise(F.col("runs")[at]["first"] - 1)
        return F.slice(F.col("lines"), begin, F.greatest(end - begin + 1, F.lit(0)))

    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("runs")), gap))
    cut = F.col("runs").isNotNull()
    n_lines = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))
    removed = F.aggregate("runs", F.lit(0), lambda n, run: n + run["last"] - run["first"] + 1)
    return joined.select(
        "doc",
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.when(cut, F.array_join(kept, "\n")).otherwise(F.col(f"doc.`{text_col}`")).alias("kept"),
    )
