"""Registered queries of the numbered operators, one each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callpay.llm import (
    chat,
    classifier,
    decontaminate,
    dialogue,
    innerproduct,
    jaccard,
    katz,
    licenses,
    mixing,
    quality_rules,
    sharding,
    templates,
    whitening,
)
from callpay.llm.shared import held_by, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


@query
def op1_nb_svm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(held_by("doc_id", 4) != 2)
    scored = classifier.score(docs, classifier.fit(docs, labels, "quality"))
    return scored.select(
        "doc_id",
        (held_by("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= classifier.CUT).cast("int").alias("predicted"),
    )


@query
def op2_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], turns.schema)
    return chat.chat_digest(chat.format_chats(turns.unionByName(more)))


@query
def op3_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = templates.drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped", "n_templates",
        F.length(text).cast("bigint").alias("kept_chars"),
        F.sha2(text, 256).alias("kept_sha256"),
    )


@query
def op4_winnowed_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (held_by("doc_id", 5) != 1).alias("train"))
    scored, words = katz.score_texts(docs.withColumn("train", F.coalesce("train", F.lit(False))))
    return scored.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(words.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


@query
def op6_proportional_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + sharding.OVERHEAD).cast("bigint").alias("size"),
        sharding.text_crc32().alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op7_license_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op8_mix_by_length_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


@query
def op9_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, percent=85)


@query
def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = stored(quality_rules.measures(docs).drop("text"), "measures")
    judged = quality_rules.judge(measured, stored(quality_rules.host_verdicts(measured), "verdicts"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op11_hirschberg_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return dialogue.conversation_report(turns, dialogue.damage(turns))


@query
def op12_bitsliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, fitted = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitening.component_rows(rows, fitted)


@query
def op13_norm_sorted_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return innerproduct.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
