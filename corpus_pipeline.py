"""A training-data pipeline of five operators: each stage's decisions take effect in the documents that the next one gets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm import langid, mixing, neardup, packing, pii
from trendloom.llm.common import materialize

#: A prediction below this posterior is no decision.
MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go; a missing lang is filled in."""
    langs, logp = langid.fit(docs, langid.fold(5) != 0)
    found = langid.predict(docs, langs, logp, keep=tuple(docs.columns))
    kept = found.filter((F.col("lang_pred") != langid.UND) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    lang = F.coalesce("row.lang", "lang_pred").alias("lang")
    return kept.select(*[lang if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the smallest doc_id."""
    found = neardup.near_duplicates(docs)
    surplus = found.filter(F.col("doc_id").isNotNull() & ~F.col("kept")).select("doc_id").distinct()
    return docs.join(surplus.hint("shuffle_hash"), "doc_id", "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that reveal it, are taken out of the texts; no document goes."""
    return pii.sanitise(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's documents, as often as they are in it."""
    return mixing.select_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the language model, the tokenizer or the packing; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
