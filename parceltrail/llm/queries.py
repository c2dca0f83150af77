"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parceltrail.llm import (
    langid,
    merkle,
    mixing,
    neural_lm,
    odd_sketch,
    packing,
    part_codes,
    quality,
    rp_forest,
    sharding,
    simhash,
    suffix,
    va_file,
)
from parceltrail.llm.common import table
from parceltrail.llm.oracle import ORACLE


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.withColumn("probability", F.round("probability", 6))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neural_lm.digest(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.digest(table(spark, sf_dir, "embeddings"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_file.digest(table(spark, sf_dir, "embeddings"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(table(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_codes.digest(table(spark, sf_dir, "embeddings"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_lm_score": op2_lm_score,
    "op3_quality": op3_quality,
    "op4_simhash": op4_simhash,
    "op5_pack": op5_pack,
    "op6_ann": op6_ann,
    "op7_exact_topk": op7_exact_topk,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_shards": op9_shards,
    "op10_langid": op10_langid,
    "op11_manifest": op11_manifest,
    "op12_codes": op12_codes,
    "op13_minhash": op13_minhash,
}

__all__ = ["ORACLE", "QUERIES"]
