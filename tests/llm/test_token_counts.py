import random

import public_tokenizers
import pytest
import tokenizers

from benchledger.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_counts_equal_the_library(library):
    own = token_counts.counter(PATH)
    chance = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz    \n\t'séüß日😀0123456789.,!?-_"
    texts = ["", " ", "a", "<|endoftext|>", "x<|endoftext|> <|endoftext|>y", "a" * 5000, "ab" * 3000, "  \n\n  x", "I'll we've"]
    texts += ["".join(chance.choice(letters) for _ in range(chance.randint(1, 300))) for _ in range(300)]
    assert [own.count(text) for text in texts] == [len(library.encode(text, add_special_tokens=False).ids) for text in texts]


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 10)
    own = token_counts.BpeCounter(PATH)
    for number in range(100):
        own.count(f"word{number} other")
    assert len(own) <= 10


def test_documents(odd, odd_rows, no_rows, documents, library):
    got = token_counts.count_tokens(odd, PATH, limit=20).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in odd_rows]
    order = lambda row: (row[0] is None, row[0] or 0)
    assert sorted([tuple(row)[:3] for row in got], key=order) == sorted(want, key=order)
    assert all(row.over_limit == (row.n_tokens > 20) for row in got)
    assert token_counts.count_tokens(no_rows, PATH).count() == 0
    texts = {row.doc_id: row.text for row in documents.collect()}
    for row in token_counts.count_tokens(documents, PATH).collect():
        assert row.n_tokens == len(library.encode(texts[row.doc_id], add_special_tokens=False).ids)
