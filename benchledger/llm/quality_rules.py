"""Quality rules: counts per document and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed word 1- and 2-grams: the trusted target (documents
labelled good) and the raw corpus (all documents). A document's value is the mean over its grams of
``ln(p_target / p_raw)``, so it does not depend on length; below the threshold it is rejected.

Words are runs of anything but space and ``\\x09-\\x0D``. Null texts have no words. A document of fewer
than ten words, or with more than a fifth of its words in repeated five-word windows, fails the base
rules and gets no further. Without trusted documents the ratio is 0 and rejects nothing. Repeated rows
are judged alike.

Everything is column expressions; the ratio's table is a constant array of ``BUCKETS`` numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchledger.llm.common import OTHERS, put_back, set_apart

SPACE = r"\x20\x09-\x0D"
WINDOW = 5
BUCKETS = 1 << 14
#: Trusted documents that the target is fitted on: those with the smallest hashes of their ids.
TARGET_DOCUMENTS = 20_000
#: The target is shrunk towards the corpus as by so many grams per bucket, so few trusted documents reject little.
SHRINKAGE = 16
THRESHOLD = -0.1


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once per row, also where ``use`` reads it many times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+"), F.lit(0))


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))


def n_repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]"))
    return let(lines, lambda own: F.size(own) - F.size(F.array_distinct(own)))


def n_repeated_words(hashes: Column) -> Column:
    """Words in windows of five that are found twice or more; ``hashes`` is one hash per word."""
    size = F.size(hashes)
    windows = F.transform(
        F.sequence(F.lit(1), size - (WINDOW - 1)), lambda at: F.xxhash64(F.slice(hashes, at, F.lit(WINDOW)))
    )

    def covered(own: Column) -> Column:
        # Equal windows become neighbours; the places of those that have an equal neighbour, in order.
        ordered = F.array_sort(F.transform(own, lambda window, at: F.struct(window.alias("window"), at.alias("at"))))

        def places(pairs: Column) -> Column:
            def repeated(pair: Column, at: Column) -> Column:
                before = F.get(pairs, at - 1)["window"] == pair["window"]
                after = F.get(pairs, at + 1)["window"] == pair["window"]
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            return F.array_sort(F.transform(F.filter(pairs, repeated), lambda pair: pair["at"]))

        start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))

        def add(state: Column, at: Column) -> Column:
            words = state["words"] + WINDOW - F.greatest(F.lit(0), state["end"] - at)
            return F.struct(words.alias("words"), (at + WINDOW).alias("end"))

        return F.aggregate(let(ordered, places), start, add, lambda state: state["words"])

    repeats = let(windows, lambda own: F.when(F.size(F.array_distinct(own)) < F.size(own), covered(own)).otherwise(0))
    return F.when(size < WINDOW, 0).otherwise(repeats)


def buckets_of(hashes: Column) -> Column:
    """The buckets of a document's 1- and 2-grams."""
    following = F.slice(hashes, F.lit(2), F.greatest(F.size(hashes) - 1, F.lit(0)))
    pairs = F.zip_with(hashes, following, lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
    grams = F.concat(hashes, F.filter(pairs, lambda pair: pair.isNotNull()))
    return F.transform(grams, lambda gram: F.pmod(gram, F.lit(BUCKETS)).cast("int"))


@dataclass(frozen=True)
class Ratio:
    """ln(p_target / p_raw) of each bucket."""

    values: tuple[float, ...]

    def column(self) -> Column:
        # A text that the optimiser turns into one constant; thousands of literals would be slow to plan.
        text = ",".join(f"{value:.4f}" for value in self.values)
        return F.split(F.lit(text), ",").cast("array<double>")

    def mean(self, buckets: Column) -> Column:
        table = self.column()
        total = F.aggregate(buckets, F.lit(0.0), lambda sum_, bucket: sum_ + F.get(table, bucket))
        return F.when(F.size(buckets) > 0, F.round(total / F.size(buckets), 6)).otherwise(F.lit(0.0))


def fit(documents: DataFrame, trusted: DataFrame, target_documents: int = TARGET_DOCUMENTS) -> Ratio:
    """The ratio of the documents whose ids are in ``trusted`` (doc_id) to all documents."""
    ids = (
        trusted.select(F.col("doc_id").cast("bigint")).dropna().distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_documents)
    )
    hashes = F.transform(words_of(F.col("text")), lambda word: F.xxhash64(word))
    counted = (
        documents.select(F.col("doc_id").cast("bigint"), "text")
        # At most target_documents rows.
        .join(F.broadcast(ids.withColumn("target", F.lit(1))), "doc_id", "left")
        .select("target", hashes.alias("hashes"))
        .select("target", F.explode(buckets_of(F.col("hashes"))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("target").alias("target"))
        .collect()  # one row for each bucket
    )
    raw, target = [1] * BUCKETS, [0] * BUCKETS
    for row in counted:
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    shrink, all_raw, all_target = SHRINKAGE * BUCKETS, sum(raw), sum(target)
    # (t + s * p_raw) / (all_target + s), over p_raw
    return Ratio(tuple(math.log((t * all_raw / r + shrink) / (all_target + shrink)) for t, r in zip(target, raw, strict=True)))


def judge(documents: DataFrame, ratio: Ratio, threshold: float = THRESHOLD) -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, kept.

    Columns of these names, in whatever case, are replaced; the others stay, whatever their names.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = words_of(F.col("text"))

    def measured(own: Column) -> Column:
        return let(
            F.transform(own, lambda word: F.xxhash64(word)),
            lambda hashes: F.struct(
                F.size(own).cast("bigint").alias("n_words"),
                F.length(F.array_join(own, "")).cast("bigint").alias("word_chars"),
                n_repeated_words(hashes).cast("bigint").alias("n_repeat_words"),
                let(buckets_of(hashes), ratio.mean).alias("ratio"),
            ),
        )

    # The generator makes the struct once per row, however many columns read it.
    rows = set_apart(documents, "text").select("text", OTHERS, F.explode(F.array(let(words, measured))).alias("_measured"))
    found = {name: F.col("_measured")[name] for name in ("n_words", "word_chars", "n_repeat_words", "ratio")}
    failed = (found["n_words"] < 10) | (100 * found["n_repeat_words"] > 20 * found["n_words"])
    made = {
        "n_words": found["n_words"],
        "word_chars": found["word_chars"],
        "n_symbols": n_symbols(text).cast("bigint"),
        "n_dup_lines": n_repeated_lines(text).cast("bigint"),
        "n_repeat_words": found["n_repeat_words"],
        "ratio": found["ratio"],
        "base_failed": failed,
        "kept": ~failed & (found["ratio"] >= threshold),
    }
    return put_back(rows, documents, ["text"], made)


def trusted_of(labels: DataFrame) -> DataFrame:
    return labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).select("doc_id")


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: the counts, base_failed, kept, and the ratio."""
    documents = documents.select(F.col("doc_id").cast("bigint"), "text")
    judged = judge(documents, fit(documents, trusted_of(labels)))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio"
    )
