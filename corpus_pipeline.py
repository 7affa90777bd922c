"""The corpus pipeline: each stage applies one corpus operator to all that the stage before it kept.

Language ID drops documents without a main language; SimHash near-dedup keeps one document of each
group; decontamination drops documents that hold benchmark passages; mixing takes documents by target
weights (some more than once, the last of a leaf cut); token output writes the rest as token ids and
returns what it reads back.  Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stargrain.llm import decontaminate, language_id, mixing, simhash, token_output
from stargrain.llm.queries import MIX_EPOCHS, MIX_SEED, MIX_WEIGHTS
from stargrain.session import scratch_dir


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, weights=MIX_WEIGHTS, max_epochs=MIX_EPOCHS, seed=MIX_SEED)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output.report(docs)


STAGES = [
    ("language_id", identify),
    ("simhash_dedup", dedup),
    ("decontamination", decontaminated),
    ("mixing", mix),
    ("token_output", tokens),
]

# XXH64, EM and byte-pair encoding have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written as Parquet to the shared checkpoint folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
