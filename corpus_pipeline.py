"""A corpus pipeline: toxicity, language, near-duplicates, benchmark passages, pieces.

Every stage reads what the one before it kept, as a Parquet table in the shared folder, and
all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm import decontaminate, language_id, sentencepiece_codec, simhash_dedup, toxicity
from jobloom.llm.common import prepare, table
from jobloom.session import stage


def keep_not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, and long ones of ambiguous language, go."""
    return language_id.in_known_language(docs)


def keep_one_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash_dedup.keep_one_of_each(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row, or a whole shorter item, with the benchmark go."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as piece ids, with the text decoded from them compared."""
    coded = sentencepiece_codec.encode_and_decode(docs, sentencepiece_codec.model_file())
    return coded.select(
        "doc_id", "n_ids", "ids",
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"), "round_trip",
    )


STAGES = [
    ("toxicity", keep_not_toxic),
    ("language_id", keep_known_language),
    ("simhash_dedup", keep_one_near_duplicate),
    ("decontamination", keep_uncontaminated),
    ("sentencepiece", encode_pieces),
]

# Learned models, checksums of hashes and segmentation are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, step in first:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
