import collections
import re

import pytest

from benchledger.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[at : at + 5]) for at in range(len(words) - 4)]
    count = collections.Counter(windows)
    hit = {at + k for at, window in enumerate(windows) if count[window] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed


MORE = [
    (31, "a b c d e f\n" * 5),
    (32, "x " * 40),
    (33, "a b c d e a b c d e a b c d"),
    (34, "<b>#1 | 5% & $3 *</b>\n\n \n<b>#1 | 5% & $3 *</b>"),
    (35, " ".join(f"w{n % 97}" for n in range(3000))),
]


def test_counts(spark, odd_rows):
    rows = [(i, t) for i, t, *_ in odd_rows] + MORE
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (32, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = quality_rules.quality(docs, labels).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r.doc_id), *(r[n] for n in names)) for r in got) == sorted((str(i), *by_hand(t)) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in got)


def test_without_trusted_documents_nothing_else_is_rejected(spark, documents, no_rows):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality_rules.quality(documents, labels).collect()
    assert all(row.kept != row.base_failed and row.ratio == 0 for row in got)
    assert quality_rules.quality(no_rows, labels).count() == 0


def test_ratio_by_brute_force(spark):
    rows = [(1, "a b c"), (2, "a b"), (3, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    ratio = quality_rules.fit(docs, docs.filter("doc_id = 2").select("doc_id"))
    grams = {1: ["a", "b", "c", "ab", "bc"], 2: ["a", "b", "ab"], 3: ["z"]}
    raw = collections.Counter(g for own in grams.values() for g in own)
    size, shrink = quality_rules.BUCKETS, quality_rules.BUCKETS * quality_rules.SHRINKAGE
    want = {
        sorted(((grams[2].count(g) * (size + sum(raw.values())) / (1 + raw[g])) + shrink) / (3 + shrink) for g in own)[0]
        for own in grams.values()
    }
    import math

    # Nine grams hardly collide in the buckets.
    assert {round(math.log(w), 6) for w in want} <= {round(v, 6) for v in ratio.values}


def test_trusted_documents_are_kept_and_junk_is_not(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 3000")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = quality_rules.quality(docs, labels).filter("not base_failed").join(labels, "doc_id")
    found = {row.quality: row for row in judged.groupBy("quality").agg({"kept": "count", "ratio": "avg"}).collect()}
    kept = {row.quality: row["count"] for row in judged.filter("kept").groupBy("quality").count().collect()}
    assert kept[1] >= 0.995 * found[1]["count(kept)"]
    assert kept.get(0, 0) <= 0.4 * found[0]["count(kept)"]


def test_clashing_columns_are_replaced(odd):
    judged = quality_rules.judge(odd.withColumnRenamed("lang", "kept"), quality_rules.Ratio((0.0,) * quality_rules.BUCKETS))
    assert dict(judged.dtypes)["kept"] == "boolean" and judged.count() == odd.count()


@pytest.mark.parametrize("size", [0, 1, 4, 5, 6, 9])
def test_short_texts(spark, size):
    docs = spark.createDataFrame([(1, " ".join(["a"] * size))], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    row = quality_rules.quality(docs, labels).collect()[0]
    assert (row.n_words, row.n_repeat_words, row.kept) == (size, size if size > 5 else 0, False)
