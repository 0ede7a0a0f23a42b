"""The queries of this subpackage: each operator with production parameters over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, chat, decontam, langid, merkle, pii, sharding, simhash_dedup, substring_dedup, token_counts
from .common import shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.format_chats(_table(spark, sf_dir, "conversations"))
    return turns.select(F.col("id").alias("conv_id"), "part", "turn", "role", "continued", "rendered")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), threshold=0.8)
    return held.select("doc_id", "item_id", F.round("similarity", 9).alias("similarity"), "first_word", "n_words")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = f"{shared_folder(spark)}/slot-maps-{uuid.uuid4().hex}"
    placed, _ = sharding.assign(_table(spark, sf_dir, "documents"), 8, store=store)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, ("<|endoftext|>",))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe_codec.digests(bpe_codec.encode(_table(spark, sf_dir, "documents"), ranks, pattern, decoded=True))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    counts = (pii.counts("_base", kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone"))
    return found.select("doc_id", *counts, F.sha2(pii.shown("_base"), 256).alias("base_sha256"), pii.shown("_spans").alias("spans"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = merkle.with_next(_table(spark, sf_dir, "documents"))
    return shown.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = substring_dedup.without_repeats(_table(spark, sf_dir, "documents"), window=13)
    return judged.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "repeats")


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), radius=3, shingle=3)
    return grouped.select("doc_id", simhash_dedup.hexadecimal().alias("fingerprint"), "component_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_chat_format, op2_language_id, op3_decontamination, op4_sharding, op5_token_counts, op6_bpe_codec, op7_pii, op8_fingerprints, op9_substring_dedup, op10_simhash_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": decontam.ORACLE_SQL}
