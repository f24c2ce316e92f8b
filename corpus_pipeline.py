"""The corpus pipeline: raw documents to packed sequences, one stage after the other.

Each stage reads what the one before has written. Stages take and return the columns of documents,
but the last, which returns the pieces of the packed sequences. NULL texts count as empty: they pass the language
stage, one of them stays after the exact copies go, and it is packed as its end token alone. Of repeated rows one
stays after the exact copies go. Empty tables pass as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.llm import exact_dedup, language_id, near_dedup, packing, secret_links
from ticketlens.llm.queries import vocabulary
from ticketlens.llm.scratch import Scratch


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those far from every language go."""
    return language_id.keep_known(docs, language_id.fit(docs, F.lit(True)))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest doc_id."""
    return exact_dedup.drop_exact(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles), that with the smallest doc_id."""
    return near_dedup.drop_near(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets found in their texts masked."""
    return secret_links.mask_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their sequence and their place in it."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=2)


STAGES = [
    ("language_id", known_languages),
    ("exact_dedup", exact_copies),
    ("minhash_near_dedup", near_copies),
    ("secret_scans", secrets),
    ("best_fit_packing", packed),
]

#: Tokenizing, classifying and similarity search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
