"""A training-corpus pipeline of five stages; each stage reads what the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import contamination, minmax, packing, quality, secrets, toxicity
from tidewater.plans.registry import table
from tidewater.session import configure, scratch_path

TOXIC = 0.7


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the ids in ``gone``, whatever columns they have."""
    same = F.col("docs.doc_id").eqNullSafe(F.col("gone.doc_id"))
    return docs.alias("docs").join(gone.select("doc_id").distinct().alias("gone"), same, "left_anti")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. The model learns from the labels of ``docs``."""
    configure(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=lambda i: ~quality.held_out(i, 3, 1))
    probability = toxicity.scorer(model)
    return docs.where(probability(F.col("text")) < TOXIC)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    configure(spark)
    return _without(docs, minmax.components(docs).where("NOT kept"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    configure(spark)
    found = contamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the text; every document stays."""
    configure(spark)
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: pieces of power-of-two length with their token ids."""
    configure(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("minhash_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Models, whole-text tokenizing and hashing are beyond SQL; the tests hold run() against
#: a brute-force version of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
