"""From raw documents to packed training sequences: language, toxicity, near-duplicates, personal data, packing.

Every stage takes what its predecessor kept, as Parquet, and does its work on all of it.  A stage drops only what its
operator rejects; the columns of ``documents`` stay until the last one, which returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from twinledger.llm import langid, nearcopies, packing, pii, toxicity
from twinledger.llm.common import free_name, table
from twinledger.sources.storage import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or unlike every language learned from the stage's own rows, go."""
    return langid.keep_known(docs, langid.fit(docs))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores as toxic go."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near copies (five words, similarity 0.8 or more) one row stays.

    That is the row with the smallest id, rows without an id coming last; among rows of one id the hash of the text
    decides, then the place.  Classes alone decide what goes: unlike rows that share an id, or have none, all stay.
    """
    row = free_name(docs, "number")
    rows, classes = nearcopies.classes(docs, row)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("text"), F.col(row).alias("row"))
    named = rows.select(F.col(row), order.alias("order")).join(classes, row)
    chosen = named.groupBy("component").agg(F.min("order").alias("order")).select(F.col("order.row").alias(row))
    return rows.join(chosen, row, "left_semi").drop(row)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of the documents with their place in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048, end_id=0)


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Tokens, models and fingerprints have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
