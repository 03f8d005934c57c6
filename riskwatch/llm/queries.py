"""The operators over the driver's tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskwatch.llm import (
    conversations,
    decontaminate,
    fill_middle,
    html_text,
    mixing,
    near_dedup,
    pieces,
    pii,
    quality,
    secrets,
    suffix_dedup,
    token_counts,
    token_output,
)
from riskwatch.llm.common import table


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_files(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damaged(table(spark, sf_dir, "conversations")))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.transform(table(spark, sf_dir, "documents")))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_output, op2_pii, op3_secrets, op4_decontamination, op5_token_counts, op6_html_text,
        op7_quality_rules, op8_sentencepiece, op9_near_dedup, op10_suffix_dedup,
        op11_conversation_repair, op12_fill_middle, op13_mixing,
    )
}
ORACLES = {
    "op4_decontamination": decontaminate.oracle(),
    "op7_quality_rules": quality.oracle(),
    "op9_near_dedup": near_dedup.oracle(),
    "op10_suffix_dedup": suffix_dedup.oracle(),
    "op12_fill_middle": fill_middle.oracle(),
    "op13_mixing": mixing.oracle(),
}
