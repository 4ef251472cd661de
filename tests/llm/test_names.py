"""Columns of a corpus whose names clash with what the operators read, make, or use on their way."""

import pytest
from pyspark.sql import functions as F

from benchledger.llm import common, decontamination, mixing, personal_data, quality_rules, url_filters
from benchledger.session import settle

NAMES = (
    "Ratio", "_measured", "_found", "Base", "rule_verdict", "Domain", "_id", "a`b", "c.d", "_others", "_tokens", "_rest", "_", "N_WORDS",
    "Items", "token", "key", "_key", "_best", "_epoch", "Epoch", "n_tokens", "host", "Verdict", "_path", "_domain", "block", "part", "_left",
)


@pytest.fixture(scope="module")
def rows(odd):
    made = [F.lit(n).alias(name) for n, name in enumerate(NAMES)]
    return settle(odd.select("doc_id", "text", "lang", "source", *made), "names")


def check(before, after, made):
    """All columns but those replaced are there, once and in order, with their values."""
    replaced = {name.lower() for name in made}
    kept = [name for name in before.columns if name.lower() not in replaced]
    assert after.columns == [*kept, *made]
    own = [name for name in kept if name in NAMES]
    got = {tuple(row) for row in after.select(*[common.quoted(name) for name in own]).collect()}
    assert got == {tuple(NAMES.index(name) for name in own)}


def test_quality(spark, rows):
    ratio = quality_rules.fit(rows, rows.select("doc_id").limit(3))
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "base_failed", "kept"]
    check(rows, quality_rules.judge(rows, ratio), made)


def test_personal_data(rows):
    found = personal_data.find(rows, personal_data.fit(rows))
    check(rows, found, ["base", "spans"])
    assert found.count() == rows.count()


@pytest.mark.parametrize("size", [1_000_000, 1])
def test_decontamination(spark, rows, size):
    benchmark = spark.createDataFrame([(1, "a b"), (2, "x y z")], "item_id bigint, text string")
    found = decontamination.find_benchmark(rows, benchmark, block_bytes=size, spans=True)
    check(rows, found, ["n_words", "hit_words", "items", "hit_spans"])
    assert found.count() == rows.count()


def test_mixing(rows):
    chosen = mixing.mix(rows, budget_share=1.0, epochs=1)
    check(rows, chosen, ["domain", "n_tokens", "epoch"])
    # The domain column is read.
    assert {row.domain for row in chosen.select("domain").collect()} == {str(NAMES.index("Domain"))}


def test_urls(rows):
    pages = rows.withColumn("Url", F.lit("http://casino.org/x"))
    judged = url_filters.judge_urls(pages, url_filters.PLACE_RULES + url_filters.WORD_RULES)
    check(pages, judged, ["host", "path", "rule_name", "rule_tier", "verdict"])
    assert {tuple(row) for row in judged.select("Url", "host", "rule_name").collect()} == {("http://casino.org/x", "casino.org", "org/")}
