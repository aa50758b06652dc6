"""The corpus pipeline over ``documents``: quality, line dedup, near duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.llm.common import WORD, read_table, stored, text_key
from clicktrail.llm.decontaminate import contaminated
from clicktrail.llm.jaccard import jaccard_classes
from clicktrail.llm.line_dedup import dedup_lines
from clicktrail.llm.mixing import earlier_sum, mixed_groups, shared_out
from clicktrail.llm.quality import score_quality, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: What tells rows apart, in columns without nulls.
KEYS = ["_id", "_no_id", "_tk"]


def keys(tk: Column) -> list[Column]:
    doc_id = F.col("doc_id")
    return [F.coalesce(doc_id, F.lit(0)).alias("_id"), doc_id.isNull().alias("_no_id"), tk.alias("_tk")]


def source_keys() -> list[Column]:
    source = F.col("source")
    return [F.coalesce(source, F.lit("")).alias("_source"), source.isNull().alias("_no_source")]


def has_words() -> Column:
    return F.regexp_like(F.coalesce("text", F.lit("")), F.lit(WORD))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below its threshold) go. It learns from all of ``labels``."""
    docs = docs.select(COLUMNS)
    net = train(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, net).where("predicted = 1").select("doc.*")


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut; a document of which nothing is left goes."""
    out = dedup_lines(docs.select(COLUMNS)).where("n_removed = 0 or n_removed < n_lines")
    changed = F.col("n_removed") > 0
    return out.select(
        "doc.doc_id",
        F.col("kept").alias("text"),
        "doc.lang",
        "doc.source",
        F.when(changed, F.length("kept").cast("long")).otherwise(F.col("doc.n_chars")).alias("n_chars"),
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Documents without words are no one's duplicates and stay. Groups are told
    apart by their links, not by ids, which may repeat or be null (a null id
    comes after all others). Of rows of a group that repeat its smallest id, the
    one of the smallest text key stays, and of rows equal in id and text that of
    the smallest lang, source and n_chars.
    """
    docs = docs.select(COLUMNS)
    classes = jaccard_classes(docs).where("leads and n_shingles > 0")
    kept = classes.select(keys(F.col("tk"))).distinct()
    row = F.struct("doc_id", "lang", "source", "n_chars", "text")
    one = docs.where(has_words()).groupBy(keys(text_key(F.col("text")))).agg(F.min(row).alias("_row"))
    return one.join(kept, KEYS).select("_row.*").select(COLUMNS).unionByName(docs.where(~has_words()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    docs = docs.select(COLUMNS)
    found = contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    leaked = found.select(F.col("doc_id").alias("l_id"), F.col("tk").alias("l_tk")).distinct()
    return docs.join(
        leaked, F.col("doc_id").eqNullSafe(F.col("l_id")) & (text_key(F.col("text")) == F.col("l_tk")), "left_anti"
    )


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents with the words taken of each, ``epochs`` whole passes and ``rest`` words more; those not taken go.

    Every document taken is one row with its whole text. Sources have their
    target shares only once readers expand the rows: the text ``epochs`` times,
    then its first ``rest`` words.
    """
    docs = docs.select(COLUMNS)
    mixed = mixed_groups(docs).select(
        *keys(F.col("text_key")), *source_keys(), "size", "source_size", "budget", F.col("at").alias("_at")
    )
    equal = (
        docs.where(has_words())
        .groupBy(*keys(text_key(F.col("text"))), *source_keys(), *[c for c in COLUMNS if c != "text"])
        .agg(F.count(F.lit(1)).alias("copies"), F.min("text").alias("text"))
    )
    shared = [*KEYS, "_source", "_no_source"]
    placed = (
        equal.withColumn("_before", earlier_sum("copies", shared, ["lang", "n_chars"]))
        .join(mixed, shared)
        .withColumn("at", F.col("_at") + F.col("_before") * F.col("size"))
    )
    out = shared_out(placed.select(*COLUMNS, "size", "source_size", "budget", "copies", "at"))
    return out.where("taken > 0").select(*COLUMNS, "size", "taken", "epochs", "rest")


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mixing", mixing),
]

#: The first stage is a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
