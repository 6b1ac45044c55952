"""A corpus from documents to token ids: five stages, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last keep the columns of
documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.llm import bpe, decontaminate, language_id, minhash, suffix_dedup
from loglake.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: null and empty texts, texts without a letter, and uncertain ones.

    Long texts are scored whole; equal texts get equal answers, so repeated rows stay or go together; of languages with
    equal scores the first by name is taken. Null ids stay if their text does. Without labelled texts all go.
    """
    model = language_id.fit(docs)
    return language_id.predict(docs.select(*COLUMNS), model).where(~F.col("rejected")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (Jaccard similarity of 0.8 or more) stays, the one with the smallest id; so do all without an id.

    Null and empty texts have no copies. Rows that share the smallest id stay together, so a row given twice does. An
    empty table stays empty.
    """
    kept = minhash.near_duplicates(docs.select("doc_id", "text"), percent=80).where("kept").select("doc_id")
    docs = docs.select(*COLUMNS)
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that also start earlier in the corpus are cut out, whole characters only; emptied documents go.

    Null, empty and short texts stay as they are, and so do rows without an id; a row given twice is one document; of
    different texts of one id that with the least hash is cleaned. An empty table stays empty.
    """
    cut = suffix_dedup.remove_repeats(docs.select(*COLUMNS), characters=True)
    text = F.when(F.size("spans") > 0, F.decode("kept", "UTF-8")).otherwise(F.col("text"))
    out = cut.withColumn("text", text).withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.where((F.size("spans") == 0) | F.col("text").rlike(r"\S")).select(*COLUMNS)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, also with other numbers or names, go; all rows of such an id do.

    Null and empty texts and rows without an id stay; without a benchmark all do.
    """
    leaks = decontaminate.leaks(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return docs.select(*COLUMNS).join(leaks.select("doc_id"), "doc_id", "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and digests of the ids and of what they decode to; a row for each row, null texts as empty ones."""
    return bpe.digests(bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json")).drop("text"), "ids")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_repeats", cut_repeats),
    ("decontamination", decontaminate_benchmark),
    ("bpe", encode),
]

#: Training, MinHash, suffix sorting and merges aren't SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
