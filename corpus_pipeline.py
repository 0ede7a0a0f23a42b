"""A corpus pipeline: language ID, near-duplicate removal, decontamination, redaction, encoding.

Each stage takes (spark, docs, sf_dir), calls one operator of tidemark.llm on all of docs and returns a DataFrame,
which is written as Parquet and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, decontam, langid, pii, simhash_dedup
from tidemark.llm.common import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; a missing label becomes the predicted one."""
    return langid.with_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return simhash_dedup.without_near_copies(docs, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind, and n_chars of the new text."""
    return pii.redacted(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of all documents, and the digests of the ids and of what they decode to."""
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe_codec.digests(bpe_codec.encode(docs, ranks, pattern, decoded=True), "ids")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("pii_redaction", redaction),
    ("bpe_encoding", encoding),
]

#: Models and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over all of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
