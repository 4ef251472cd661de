import numpy as np

from benchledger.llm import language_id
from tests.llm.conftest import SCHEMA


def test_grams_by_brute_force():
    texts = ["Ab c", "", "É1é", "x" * 50]

    def by_hand(text):
        data = b" %b " % b" ".join(text.lower().encode().translate(language_id.LETTERS_ONLY).split())
        counts = np.zeros(language_id.DIMENSIONS, np.int64)
        for size in (2, 3):
            for at in range(len(data) - size + 1):
                gram = int.from_bytes(data[at : at + size], "little") | (1 << 25 if size == 2 else 0)
                counts[(gram * 2654435761 % 2**32) >> 20] += 1
        return counts

    got = np.concatenate(list(language_id.gram_counts(texts)))
    assert (got == np.stack([by_hand(text) for text in texts])).all()


def test_long_texts_are_counted_whole(monkeypatch):
    text = "abc def " * 400
    whole = np.concatenate(list(language_id.gram_counts([text, "x", text])))
    monkeypatch.setattr(language_id, "CHUNK_BYTES", 100)
    pieces = np.concatenate(list(language_id.gram_counts([text, "x", text])))
    assert (whole == pieces).all() and whole[0].sum() == 2 * len(text.strip()) + 1


def test_held_out_accuracy(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.held_out_languages(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [row for row in rows if row.held_out]
    assert len(rows) == 1000 and len(held) > 100
    assert sum(row.lang == row.lang_pred for row in held) >= 0.97 * len(held)
    assert all(0 <= row.score <= 1 for row in rows)


def test_edges(spark, odd, odd_rows, no_rows):
    rows = language_id.held_out_languages(odd).collect()
    assert len(rows) == len(odd_rows)
    found = {row.doc_id: row for row in rows}
    for doc_id in (3, 4, 5, 9, 12):
        assert (found[doc_id].lang_pred, found[doc_id].score) == ("und", 0.0)
    assert {found[i].lang_pred for i in (1, 2, 6, 10, 11)} <= {"en", "de"}
    assert language_id.held_out_languages(no_rows).count() == 0
    unlabelled = spark.createDataFrame([(1, "abc", None, None, 1)], SCHEMA)
    assert [row.lang_pred for row in language_id.held_out_languages(unlabelled).collect()] == ["und"]


def test_far_texts_are_rejected(documents):
    model = language_id.fit(documents)
    _, _, rejected = model.predict(["qqq zzz xxx qzx", documents.first().text, "123"])
    assert rejected == [True, False, True]
