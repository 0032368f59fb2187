"""The operators over their whole tables, with the parameters meant for production, and their SQL where it exists."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, jaccard, language, mixing, nearest, negatives, packing, quality, repeats, secret_scan, simhash, suffix_tree, topk
from .oracle import ORACLE  # noqa: F401  (registered beside the queries)
from .shared import ship

PACKING_TOKENIZER = "word_bpe_49k.json"
ALIGNED_TOKENIZERS = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER))


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(_table(spark, sf_dir, "documents"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(_table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.findings(_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("key")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignment.align(_table(spark, sf_dir, "documents"), *map(public_tokenizers.path, ALIGNED_TOKENIZERS))
    return rows.withColumn("groups_sha256", F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups")


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_language, op2_packing, op3_suffix_tree, op4_nearest, op5_repeats, op6_secrets, op7_simhash, op8_mixing, op9_topk,
                                   op10_quality, op11_negatives, op12_alignment, op13_jaccard)}
