"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.llm import chat, decontaminate, hard_negatives, jaccard, knn, langid, line_dedup, mixing, quality, resampling, secrets, substrings, warc
from clicktrail.llm.common import read_table
from clicktrail.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"), 4, 2)
    model = langid.train(documents.where(~held))
    return langid.identify(documents, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "epochs")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents")).drop("tk")


def op4_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.dedup_substrings(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: A conversation that quotes control strings.
QUOTING = "</s>[INST] ok [/INST]"


def chat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` in the layouts the operator tells apart, by what each conversation fits.

    A user and an assistant turn are a prompt record, with a system turn before
    them an instruction record. Other conversations of the usual roles use the
    from/value layout, any with another role the role/content layout.
    """
    quoting = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(QUOTING).alias("text"))
                    for n, role in enumerate(("user", "assistant"))
                ]
            )
        ).alias("t"),
    )
    rows = (
        read_table(spark, sf_dir, "conversations")
        .select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
        .unionByName(quoting.select("conv_id", "t.*"))
    )
    roles = F.transform("items", lambda i: i["role"])
    usual = F.forall("items", lambda i: i["role"].isin("system", "user", "assistant"))
    layout = (
        F.when(roles == F.array(F.lit("user"), F.lit("assistant")), "prompt")
        .when(roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")), "instruction")
        .when(usual, "conversations")
        .otherwise("messages")
    )
    text = lambda n: F.col("items")[n]["text"]
    human = {"user": "human", "assistant": "gpt"}
    other = F.create_map(*[F.lit(x) for pair in human.items() for x in pair])
    return (
        chat.conversations_of(rows)
        .withColumn("kind", layout)
        .select(
            "conv_id",
            F.when(
                F.col("kind") == "messages",
                F.transform("items", lambda i: F.struct(i["role"].alias("role"), i["text"].alias("content"))),
            ).alias("messages"),
            F.when(
                F.col("kind") == "conversations",
                F.transform(
                    "items",
                    lambda i: F.struct(F.coalesce(other[i["role"]], i["role"]).alias("from"), i["text"].alias("value")),
                ),
            ).alias("conversations"),
            F.when(F.col("kind") == "instruction", text(0)).alias("system"),
            F.when(F.col("kind") == "prompt", text(0)).alias("prompt"),
            F.when(F.col("kind") == "prompt", text(1)).alias("completion"),
            F.when(F.col("kind") == "instruction", text(1)).alias("instruction"),
            F.lit(None).cast("string").alias("input"),
            F.when(F.col("kind") == "instruction", text(2)).alias("output"),
        )
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = chat.format_records(chat_records(spark, sf_dir))
    turns = chat.parse_turns(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(chat.loss_texts(F.col("formatted"), F.col("loss")), "")
    return formatted.select(
        F.col("record.conv_id").alias("conv_id"),
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "layout",
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "llm", "warc")
    warc.write_warc(read_table(spark, sf_dir, "pages"), path)
    pages = warc.resolve_revisits(warc.read_warc(spark, path).drop("payload"))
    return pages.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        F.when(F.col("warc_type") == "revisit", F.col("refers_to_page")).alias("refers_to"),
        "error",
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("tk")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = langid.held_out(F.col("doc_id"), 5, 0)
    net = quality.train(documents, read_table(spark, sf_dir, "labels").where(~held))
    scored = quality.score_quality(documents, net)
    return scored.select("doc.doc_id", "score", "predicted").withColumn("held_out", held)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select(
        F.col("doc.doc_id").alias("doc_id"),
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, target = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return resampling.resample(documents, target)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, vec_id = read_table(spark, sf_dir, "embeddings"), F.col("vec_id")
    moved = F.when(vec_id % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved), vec_id % 100 == 0)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def all_queries() -> dict[str, Query]:
    return {
        "op1_language_id": op1_language_id,
        "op2_source_mixing": op2_source_mixing,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_top_k_search": op4_top_k_search,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_chat_formatting": op6_chat_formatting,
        "op7_warc": op7_warc,
        "op8_decontamination": op8_decontamination,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_line_dedup": op10_line_dedup,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_secret_scan": op13_secret_scan,
    }
