import hashlib
import re

import pytest

from benchledger.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def by_hand(rows, items):
    windows = {}
    for item, text in items:
        words = WORD.findall(lowered(text))
        size = min(10, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[at : at + size]), set()).add(item)
    made = []
    for doc_id, text in rows:
        words = WORD.findall(lowered(text))
        hit, found = set(), set()
        for size in {len(window) for window in windows}:
            for at in range(len(words) - size + 1):
                owners = windows.get(tuple(words[at : at + size]))
                if owners:
                    found |= owners
                    hit |= set(range(at, at + size))
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        made.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(made, key=str)


ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"),
    (2, "short Item"),
    (3, None),
    (4, "... !!!"),
    (10, "short item"),
    (11, "two three four five six seven eight nine ten eleven Ünï日"),
]


@pytest.fixture(scope="module")
def benchmark_rows(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


@pytest.fixture(scope="module")
def rows(spark, odd_rows):
    more = [
        (21, "x ONE-two three,four five six seven eight nine ten! eleven y"),
        (22, "a short item, short\nitem short itemx xshort item"),
        (23, "two three four five six seven eight nine ten eleven ünï日 Ünï日"),
    ]
    return [(i, t) for i, t, *_ in odd_rows] + more


def test_digest_columns(spark, rows, benchmark_rows, no_rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = decontamination.contamination(docs, benchmark_rows)
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(rows, ITEMS)
    assert decontamination.contamination(no_rows, benchmark_rows).count() == 0
    clean = decontamination.contamination(docs, benchmark_rows.limit(0)).collect()
    assert len(clean) == len(rows) and not any(row.contaminated for row in clean)


def test_blocks_give_the_same(spark, rows, benchmark_rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    one, *many = (
        decontamination.find_benchmark(docs, benchmark_rows, block_bytes=size, spans=True, part_bytes=part).collect()
        for size, part in ((1_000_000, 1), (1, 1_000_000), (40, 2_000), (1, 60_000))
    )
    assert all(sorted(map(str, one)) == sorted(map(str, other)) for other in many)
    none = docs.limit(0)
    assert decontamination.find_benchmark(none, benchmark_rows, block_bytes=1).count() == 0


def test_spans_are_places_in_the_text(spark, benchmark_rows):
    text = "é日 (Short) ITEM. and 😀 short-item"
    docs = spark.createDataFrame([(1, text, 5)], "doc_id bigint, text string, items int")
    row = decontamination.find_benchmark(docs, benchmark_rows, spans=True).collect()[0]
    assert [text[a:b] for a, b in row.hit_spans] == ["Short) ITEM", "short-item"]
    assert row["items"] == [2, 10]


def test_given_tables(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = decontamination.contamination(documents, benchmark).collect()
    want = by_hand([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    assert sorted(map(tuple, got), key=str) == want
