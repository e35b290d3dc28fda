"""Training-data pipeline over ``documents``: identify the language, dedup, decontaminate, tokenise.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared folder and
hands the reread table to the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.llm import bpe, decontam, langid, minhash, suffixes
from stormledger.llm.common import bounded_batches, stage, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts that fit no learned language; learns from the labelled rows."""
    bounded_batches(spark)
    return langid.keep_identified(docs, langid.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, similarity 0.8 or more."""
    bounded_batches(spark)
    return minhash.keep_one(docs, words=5, percent=80)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated 400-byte passages out of the texts; ``n_chars`` follows the text where there is such a column."""
    bounded_batches(spark)
    shorter = suffixes.remove_duplicates(docs)
    if "n_chars" in docs.columns:
        shorter = shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return shorter.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that contain a benchmark item, up to edits."""
    bounded_batches(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    bounded_batches(spark)
    return bpe.round_trip(docs.select("doc_id", "text"), with_ids=True).drop("text")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("passage_dedup", remove_repeated_passages),
    ("decontamination", decontaminate),
    ("bpe", tokenise),
]

# Sketches, n-gram kernels, the edit embedding and BPE are not expressible in SQL; the tests compare the
# stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
