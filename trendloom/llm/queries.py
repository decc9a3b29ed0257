"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import htmltext, langid, mixing, neardup, packing, pii, quality, suffixdedup, topk, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_read(spark, sf_dir, "documents")).drop("class_distance", "word_distance", "ref_lang")


def op2_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_read(spark, sf_dir, "documents"))


def op3_language_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op4_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"))


def op5_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_read(spark, sf_dir, "documents"))


def op6_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.repeats(_read(spark, sf_dir, "documents")).drop("kept")


def op8_lineblock_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_read(spark, sf_dir, "pages"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.topk(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_divergence": op1_quality_divergence,
        "op2_hierarchical_mix": op2_hierarchical_mix,
        "op3_language_bayes": op3_language_bayes,
        "op4_minhash_neardup": op4_minhash_neardup,
        "op5_disclosure_pii": op5_disclosure_pii,
        "op6_channel_toxicity": op6_channel_toxicity,
        "op7_suffix_repeats": op7_suffix_repeats,
        "op8_lineblock_html": op8_lineblock_html,
        "op9_exact_topk": op9_exact_topk,
        "op10_bestfit_packing": op10_bestfit_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_divergence": quality.oracle(), "op2_hierarchical_mix": mixing.oracle(), "op9_exact_topk": topk.ORACLE}
