"""The registered queries of this subpackage: each applies one operator to its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpulse.llm import ann, bpe, chat, collocations, counts, decontaminate, lm, paragraphs, repair, repeats, rules, simhash, toxicity
from cellpulse.staging import new_path


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.Repeats(documents(spark, folder)).removed()


def op2_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(documents(spark, folder), ranks, public_tokenizers.PATTERN)


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.components(documents(spark, folder))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every call starts an empty cache, so that all distinct texts are encoded."""
    tokenizer = counts.tokenizer_file(spark, public_tokenizers.path("byte_bpe_50k.json"))
    found = counts.counted(documents(spark, folder), tokenizer, new_path(spark, "token-counts"))
    return found.withColumn("over_limit", F.col("n_tokens") > 512)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    classifier = toxicity.fitted(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return toxicity.scored(docs, classifier).select(
        "doc_id", (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    told = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string"
    )
    part = F.struct(
        F.lit("text").alias("kind"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    )
    messages = told.unionByName(extra).withColumn("parts", F.array(part)).drop("text")
    return chat.digests(chat.formatted(messages))


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scored(documents(spark, folder))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.by_document(documents(spark, folder)).select(
        "doc_id", "component_id", "n_paragraphs", "n_removed",
        F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"]).alias("removed_chars"),
    )


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    book = rules.applied(rules.ledger(documents(spark, folder)), "v2")
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(rules.mask("base"))) != 0).alias("base_failed"), "kept",
        "n_lines", "n_capitals", "failed",
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    told = spark.read.parquet(f"{folder}/conversations.parquet")
    return repair.audited(repair.damaged(told), told)


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.ranked(documents(spark, folder))


def op13_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return ann.searched(ann.indexed(vectors), vectors.filter("vec_id % 20 = 0"))


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_byte_level_bpe": op2_byte_level_bpe,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_toxicity": op5_toxicity,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}
