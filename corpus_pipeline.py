"""A training corpus from ``documents``: five stages, each a written table that the next one reads.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``, whatever those are. Nulls: a document without text fails the quality rules; one without
doc_id cannot be compared with others and is no duplicate. Of rows that repeat a doc_id, one stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchledger.llm import decontamination, mixing, near_duplicates, personal_data, quality_rules
from benchledger.llm.common import table
from benchledger.session import settle

READ = ("doc_id", "text")


def apart(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the other columns as one, so that an operator's columns clash with none."""
    rest = [F.col(name) for name in docs.columns if name not in READ]
    return docs.select(*READ, F.struct(F.lit(0).alias("_"), *rest).alias("_rest"))


def together(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from rows made by :func:`apart`."""
    return rows.select(*[F.col(name) if name in READ else F.col("_rest")[name].alias(name) for name in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ratio = quality_rules.fit(docs, quality_rules.trusted_of(table(spark, sf_dir, "labels")))
    return together(quality_rules.judge(apart(docs), ratio).filter("kept"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each class of near duplicates."""
    classes = near_duplicates.near_duplicates(docs)
    first = classes.filter(F.col("doc_id") == F.col("class_id")).select("doc_id")
    named = apart(docs).filter(F.col("doc_id").isNotNull()).join(first, "doc_id", "left_semi")
    one = named.groupBy("doc_id").agg(F.min_by(F.struct("text", "_rest"), F.xxhash64("text")).alias("own"))
    unnamed = apart(docs).filter(F.col("doc_id").isNull())
    return together(one.select("doc_id", "own.text", "own._rest").union(unnamed), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = decontamination.find_benchmark(apart(docs), table(spark, sf_dir, "benchmark"))
    return together(found.filter(F.size("hit_words") == 0), docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind in place of personal data; n_chars is that of the new text."""
    found = personal_data.find(apart(docs), personal_data.fit(docs))
    text = F.when(F.col("text").isNotNull(), personal_data.redacted(F.col("text"), F.col("spans")))
    rows = together(found.withColumn("text", text), docs)
    if "n_chars" not in docs.columns:
        return rows
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, one row per epoch, with domain, n_tokens and epoch."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
]
#: The classes and the fitted models are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
