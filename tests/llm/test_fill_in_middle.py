import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from benchledger.llm import fill_in_middle as fim


def by_hand(doc_id, text, marks=("<P>", "<S>", "<M>"), transformed=100, suffix_first=50, pattern=r"[^\n]*\n|[^\n]+"):
    text = text or ""
    units = re.findall(pattern, text, re.S)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    parts = ["".join(units[:low]), "".join(units[low:high]), "".join(units[high:])]
    prefix, suffix, middle = marks
    if not text or any(mark in text for mark in marks) or h[2] % 100 >= transformed:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < suffix_first:
        return doc_id, n, "spm", len(parts[0]), len(parts[1]), suffix + parts[2] + prefix + parts[0] + middle + parts[1]
    return doc_id, n, "psm", len(parts[0]), len(parts[1]), prefix + parts[0] + suffix + parts[2] + middle + parts[1]


def some_texts():
    chance = random.Random(3)
    texts = ["".join(chance.choice("ab\n\né日😀 <") for _ in range(chance.randrange(40))) for _ in range(300)]
    texts += [None, "", "\n", "\n" * 17, "a", "é", "😀\n😀", "a<P>b\nc\n", "<S\n>", "<M>", "a\r\nb\r\nc", "<\n<\n<P\n", "x" * 100_000, "é\n" * 60_000]
    return list(enumerate(texts))


@pytest.mark.parametrize(("unit", "pattern"), [("line", r"[^\n]*\n|[^\n]+"), ("code_point", ".")])
def test_equals_cutting_by_hand(spark, unit, pattern):
    rows = [*some_texts(), (None, "a\nb\nc"), (3, "a\nb"), (3, "a\nb")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    made = fim.fill_in_middle(docs, unit).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    order = lambda row: (row[0] is None, row[0] or 0, row[5])
    assert sorted((tuple(row)[:6] for row in made), key=order) == sorted((by_hand(*row, pattern=pattern) for row in rows), key=order)
    texts = sorted(text or "" for _, text in rows)
    assert sorted(row.back for row in made) == texts
    assert {row.form for row in made} == {"plain", "psm", "spm"}


def test_small_slices_and_other_settings(spark, monkeypatch):
    monkeypatch.setattr(fim, "SLICE_BYTES", 50)
    marks = ("[p]", "{s}", "(m)")
    docs = spark.createDataFrame(some_texts(), "doc_id bigint, text string").repartition(1)
    got = fim.fill_in_middle(docs, transformed=60, suffix_first=20, marks=marks).collect()
    assert sorted(tuple(row)[:6] for row in got) == [by_hand(i, text, marks, 60, 20) for i, text in some_texts()]


def test_select_is_the_inverse_of_rank():
    chance = np.random.default_rng(5)
    for share in (0.0, 0.02, 0.5, 1.0):
        data = np.where(chance.random(4096) < share, 10, chance.integers(0, 256, 4096)).astype(np.uint8)
        data[data == 10] = np.where(chance.random((data == 10).sum()) < share, 10, 11)
        found = fim.Marked(np.append(fim.marked_bytes(data.view("<u8"), fim.LINE_FEED), np.uint64(0)))
        places = np.flatnonzero(data == 10)
        assert (found.select(np.arange(len(places))) == places).all()
        assert (found.rank(np.arange(4097)) == np.concatenate([[0], np.cumsum(data == 10)])).all()


def test_bytes_next_to_the_mark_are_not_marked():
    data = np.array([10, 11, 9, 0, 0x8A, 0x0A, 0xFF, 0x0A] * 2, np.uint8)
    marked = fim.marked_bytes(data.view("<u8"), fim.LINE_FEED).view(np.uint8)
    assert (marked == np.where(data == 10, 0x80, 0)).all()


def test_arrays_with_an_offset():
    texts = pa.array(["skipped", None, "a\nb", "", "ü\nü\n"])
    units, prefix, middle = fim.cut(texts.slice(1), np.array([5, 1, 0, 1]), np.array([9, 2, 3, 2]), "line")
    assert units.tolist() == [0, 2, 0, 2]
    assert prefix.tolist() == [0, 2, 0, 2] and middle.tolist() == [0, 1, 0, 2]


def test_edges(odd, no_rows):
    clashing = odd.select("doc_id", "text", F.lit(1).alias("N"), F.lit(2).alias("digest"), F.lit(3).alias("cuts"), F.lit(4).alias("a`b"), F.lit(5).alias("others"))
    rows = fim.fill_in_middle(clashing).collect()
    assert len(rows) == clashing.count()
    assert {tuple(row.others) for row in rows} == {(1, 2, 3, 4, 5)}
    assert fim.fill_in_middle(no_rows).count() == 0 and fim.digests(no_rows).count() == 0
    assert all(row.restored_sha256 == hashlib.sha256((text or "").encode()).hexdigest() for row, text in zip(
        fim.digests(odd.filter("doc_id in (1, 6, 10)")).orderBy("doc_id").collect(),
        [row.text for row in odd.filter("doc_id in (1, 6, 10)").orderBy("doc_id").collect()], strict=True))


def test_marks_that_could_arise_by_chance_are_refused():
    for marks in (("<P>", "<P>", "<M>"), ("aa", "b", "c"), ("<P", "<P>", "<M>"), ("", "b", "c"), ("ab", "b", "c")):
        with pytest.raises(ValueError):
            fim.checked_marks(marks)
