"""One query for each corpus operator, with production parameters, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from benchledger.llm import (
    decontamination,
    fill_in_middle,
    html_extraction,
    language_id,
    lm_scoring,
    mixing,
    near_duplicates,
    personal_data,
    quality_rules,
    simhash,
    spelling_variants,
    token_counts,
    url_filters,
)
from benchledger.llm.common import table

VOCABULARY = "byte_bpe_50k.json"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.main_texts(table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.held_out_languages(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.url_verdicts(table(spark, sf_dir, "pages"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.document_variants(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    function.__name__: function
    for function in (
        op1_html_extraction,
        op2_language_id,
        op3_personal_data,
        op4_token_counts,
        op5_decontamination,
        op6_mixing,
        op7_quality_rules,
        op8_url_filters,
        op9_lm_scoring,
        op10_near_duplicates,
        op11_spelling_variants,
        op12_fill_in_middle,
        op13_simhash,
    )
}
#: SQL for the queries that it can express; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op8_url_filters": url_filters.ORACLE,
    "op12_fill_in_middle": fill_in_middle.ORACLE,
}
