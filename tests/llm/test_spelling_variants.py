import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from benchledger.llm import spelling_variants as spelling
from benchledger.session import settle

WORDS = "word string, n bigint"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def variants_by_hand(n, ratio=2):
    near = {word: [] for word in n}
    for a, b in combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)

    def form(word):
        best = min(near[word], key=lambda other: (-n[other], other), default=None)
        return best if best is not None and n[best] >= ratio * n[word] else None

    def root(word):
        while form(word):
            word = form(word)
        return word

    return {(word, form(word), root(word), n[word], len(near[word]), n.get(form(word))) for word in n}


def words_by_hand(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            total[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {word: n for word, n in total.items() if len(word) >= 5 and n >= 3}


@pytest.mark.parametrize(("letters", "sizes"), [("ab", (4, 9)), ("abcdé", (5, 8)), ("aaab", (4, 14))])
def test_equals_all_pairs(spark, letters, sizes):
    chance = random.Random(len(letters))
    n = {"".join(chance.choice(letters) for _ in range(chance.randint(*sizes))): chance.choice([3, 3, 5, 6, 12, 100]) for _ in range(250)}
    words = spark.createDataFrame(list(n.items()), WORDS)
    got = spelling.spelling_variants(words).collect()
    assert set(map(tuple, got)) == variants_by_hand(n) and len(got) == len(n)
    got = spelling.spelling_variants(words, ratio=5).collect()
    assert set(map(tuple, got)) == variants_by_hand(n, 5)


def test_every_edit_of_a_word_is_found(spark):
    word = "abcabdéa"
    edits = {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in "aézÿ"} | {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in "abéz"}
    edits |= {word[:i] + word[i + 1 :] for i in range(len(word))}
    n = {other: 4 for other in edits} | {word: 9}
    got = {row.word: row for row in spelling.spelling_variants(spark.createDataFrame(list(n.items()), WORDS)).collect()}
    assert got[word].n_near == len(edits - {word})
    assert set(map(tuple, got.values())) == variants_by_hand(n)


def test_pivots_cost_least_among_disjoint_places():
    chance = random.Random(6)
    for _ in range(300):
        word = "".join(chance.choice("abc") for _ in range(chance.randint(4, 10)))
        grams = sorted({word[i : i + 2] for i in range(len(word) - 1)})
        counts = sorted(chance.randrange(1, 50) for _ in grams)
        order = {gram: number for number, gram in enumerate(chance.sample(grams, len(grams)))}
        prefix = spelling.prefix_of(word, order)
        third = sorted(order[word[i : i + 2]] for i in range(len(word) - 1))[2]
        assert sorted(i for _, i in prefix) == [i for i in range(len(word) - 1) if order[word[i : i + 2]] <= third]
        cost = {place: counts[number] for number, place in prefix}
        want = min(cost[a] + cost[b] for a, b in combinations(sorted(cost), 2) if b - a >= 2)
        pivots = sorted(spelling.pivots_of(prefix, counts))
        assert len(pivots) == 2 and pivots[1] - pivots[0] >= 2 and sum(cost[p] for p in pivots) == want


def test_words_of_documents(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [*map(tuple, docs.collect()), (None, "Étude ÉTUDE étude Ætat×on abcde_fghij klmno9pqrst " * 3), (None, None), (1, ""), (2, "a " * 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("N", F.lit(1)).withColumn("word", F.lit("x"))
    for held in (200_000, 50):
        monkeypatch.setattr(spelling, "HELD", held)
        counts = spelling.word_counts(docs, 5, 97).filter("n >= 3").collect()
        assert dict(map(tuple, counts)) == words_by_hand(rows) and len(counts) > 2000
    got = {row.word: row for row in spelling.document_variants(docs).collect()}
    assert {word: row.n for word, row in got.items()} == words_by_hand(rows)


def test_chains_of_forms_end_at_the_root(spark):
    n = {"aaaaaaaa"[:i] + "bbbbbbbb"[i:]: 2 ** (i + 2) for i in range(9)}
    got = {row.word: row for row in spelling.spelling_variants(spark.createDataFrame(list(n.items()), WORDS)).collect()}
    assert all(row.root == "aaaaaaaa" for row in got.values()) and got["bbbbbbbb"].form == "abbbbbbb"
    assert set(map(tuple, got.values())) == variants_by_hand(n)


def test_edges(spark, odd, no_rows):
    assert spelling.document_variants(no_rows).count() == 0
    clashing = odd.withColumnRenamed("lang", "word").withColumnRenamed("source", "key")
    assert spelling.document_variants(clashing).count() == len(words_by_hand([(row.doc_id, row.text) for row in odd.collect()]))
    with pytest.raises(Exception, match="four or more"):
        spelling.spelling_variants(spark.createDataFrame([("abc", 5), ("abd", 5)], WORDS)).collect()
    alone = spelling.spelling_variants(spark.createDataFrame([("abcde", 5)], WORDS)).collect()
    assert list(map(tuple, alone)) == [("abcde", None, "abcde", 5, 0, None)]


def test_no_side_of_a_join_is_broadcast(spark, monkeypatch):
    """A word's keys are many times its bytes in the file of words, by which Spark would judge."""
    plans = []

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return settle(df, name)

    monkeypatch.setattr(spelling, "settle", noted)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        words = spark.createDataFrame([("abcdef", 9), ("abcdeg", 3), ("abcde", 4)], WORDS)
        result = spelling.spelling_variants(words)
        plans.append(result._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    joins = [plan for plan in plans if "Join" in plan]
    assert len(joins) >= 4
    assert not [plan for plan in joins if "Broadcast" in plan]
