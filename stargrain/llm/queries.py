"""The corpus operators applied to the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stargrain.llm import (chat, decontaminate, fingerprint, language_id, licenses, merkle, mixing, periodic, pii, quality_rules, secrets, simhash, sql,
                           token_output)
from stargrain.llm.common import table

# Target weights by level; names that are not listed weigh 1.
MIX_WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 5, "de": 3, "fr": 3, "es": 2},
    "source": {"src0": 2},
}
MIX_EPOCHS = 3
MIX_SEED = 42


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"), weights=MIX_WEIGHTS, max_epochs=MIX_EPOCHS, seed=MIX_SEED)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.report(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language_id, op2_mixing, op3_secrets, op4_pii, op5_fingerprints, op6_chat, op7_decontamination, op8_simhash,
        op9_token_output, op10_licenses, op11_periodic, op12_merkle, op13_quality)
}

# The others need XXH64, a trained model, statistics or a tokenizer; tests hold them against brute force.
ORACLE: dict[str, str] = {
    "op2_mixing": sql.mixing_sql(MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED),
    "op6_chat": chat.ROTATE_SQL,
    "op7_decontamination": sql.overlap_sql(),
    "op12_merkle": merkle.REPORT_SQL,
    "op13_quality": quality_rules.REPORT_SQL,
}
