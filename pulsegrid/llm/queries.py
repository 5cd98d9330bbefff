"""The registered queries: each operator over its whole table, digest columns derived from its output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import (byte_bpe, chat_format, decontam, exact_dedup, kd_shards, lang_rank, license_scan, merkle,
                           near_dedup, packing, prefix_trie, quality_fm, token_store)
from pulsegrid.llm.common import table


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kd_shards.kd_shards(table(spark, sf_dir, "documents"), n_shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                      "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.quality_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_digest(table(spark, sf_dir, "documents"))


def op4_lang_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_rank.language_rows(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                 window=decontam.PASSAGE)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), width=3, percent=85, bands=24, rows=5)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digest(table(spark, sf_dir, "conversations"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("node")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_kd_shards, op2_quality_fm, op3_token_store, op4_lang_rank, op5_license_scan, op6_decontaminate,
    op7_exact_dedup, op8_odd_sketch, op9_chat_format, op10_packing, op11_merkle_manifest, op12_prefix_trie,
    op13_byte_bpe)}
ORACLES = {"op7_exact_dedup": exact_dedup.SQL, "op8_odd_sketch": near_dedup.SQL,
           "op9_chat_format": chat_format.SQL, "op11_merkle_manifest": merkle.SQL, "op12_prefix_trie": prefix_trie.SQL}
