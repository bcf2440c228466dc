"""A training corpus in five stages.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; its
result is written as Parquet and read again as the next stage's `docs`. All
but the last return the columns of `docs`, whatever their names. An empty table
gives an empty result of the same columns.
"""

from __future__ import annotations

from citeloom.llm import exact_dedup, ngram_join, packing, pii, quality_rules
from citeloom.llm.common import cut, remove, shared_folder
from pyspark.sql import DataFrame, SparkSession


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep.

    A null or empty text has fewer words than any document needs and goes. Rows
    are judged one by one, so repeated rows and rows without an id stay or go
    alike, and very long texts are counted whole.
    """
    return quality_rules.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts, that with the largest id.

    A null text counts as empty; a null id is smaller than any other; of rows
    that share the id as well exactly one stays.
    """
    return exact_dedup.keep_distinct(docs)


def near_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each class of near-duplicates, of the rows with its least id.

    Rows without an id or without words are in no class and stay. Rows that
    share an id are told apart by their shingles.
    """
    return ngram_join.keep_one_of_each(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; `n_chars` follows. Null and empty texts stay as they are, and no row goes."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place.

    A null or empty text is the end id alone; rows with equal or null ids are
    documents of their own; columns other than id and text are left out.
    """
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("exact_dedup", distinct), ("ngram_join", near_distinct), ("pii", private), ("packing", packed)]

#: Not expressible in SQL: EM, MinHash and the tokenizer; tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared checkpoint folder and read again.

    The last result is cut, so the stages' folders can go before it is read.
    """
    folder = shared_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    out = cut(STAGES[-1][1](spark, docs, sf_dir))
    remove(spark, folder)
    return out
