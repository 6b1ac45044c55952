"""The registered queries of the ten operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import bpe, chat, common, decontaminate, language_id, licenses, minhash, quality, sql, suffix_dedup, toxicity, vamana
from loglake.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = common.fold(F.col("doc_id"), 3) == 1
    model = language_id.fit(docs.where(~held))
    out = language_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "kept", "class_id")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.digests(suffix_dedup.remove_repeats(docs))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vamana.nearest(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = common.fold(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs.where(~held), table(spark, sf_dir, "labels").where(~held))
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = chat.hard(spark)
    return chat.digests(chat.conversations(rows.unionByName(hard)))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = common.fold(F.col("doc_id"), 5) == 0
    model = quality.fit(docs.where(~held), table(spark, sf_dir, "labels").where(~held))
    return quality.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_language_id": op1_language_id, "op2_minhash_dedup": op2_minhash_dedup, "op3_bpe": op3_bpe, "op4_suffix_dedup": op4_suffix_dedup, "op5_decontaminate": op5_decontaminate, "op6_nearest": op6_nearest, "op7_toxicity": op7_toxicity, "op8_license_scan": op8_license_scan, "op9_chat_format": op9_chat_format, "op10_quality": op10_quality}


def oracle_sql() -> dict[str, str]:
    return {"op2_minhash_dedup": sql.NEAR_DUPLICATES, "op4_suffix_dedup": sql.REPEATS, "op8_license_scan": licenses.oracle_sql(), "op9_chat_format": chat.ORACLE_SQL}
