import random

import numpy as np
import pytest

from benchledger.llm import near_duplicates as near


def classes_by_hand(rows, idf, threshold=0.8):
    """All pairs of texts with words, compared exactly."""
    rows = sorted(rows)
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for place, (one, text) in enumerate(rows):
        for other, other_text in rows[:place]:
            if root(one) != root(other) and near.weighted_jaccard(text or "", other_text or "", idf) >= threshold:
                a, b = sorted((root(one), root(other)))
                parent[b] = a
    return {i: root(i) for i, _ in rows}


def edited(words, chance, edits):
    words = list(words)
    for _ in range(edits):
        words[chance.randrange(len(words))] = f"w{chance.randrange(10**9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies at many distances, a chain of them, texts that share a passage, short texts."""
    chance = random.Random(11)
    word = lambda: f"v{chance.randrange(5000)}"
    made = []
    for _ in range(12):
        text = [word() for _ in range(chance.choice([30, 120, 400]))]
        made += [" ".join(text)] * chance.choice([1, 3])
        made += [edited(text, chance, e) for e in (1, 1, 2, 3, 6)]
    step = [word() for _ in range(200)]
    for _ in range(12):
        step = edited(step, chance, 3).split()
        made.append(" ".join(step))
    passage = [word() for _ in range(60)]
    made += [" ".join(passage + [word() for _ in range(30)]) for _ in range(30)]
    made += ["a b", "A  B", "a b c", "", None, " ", "one two three four five"]
    return list(enumerate(made))


def test_classes_equal_all_pairs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    idf = near.inverse_frequencies(docs)
    got = {row.doc_id: row.class_id for row in near.near_duplicates(docs).collect()}
    want = classes_by_hand(rows, idf)
    invented = [(a, b) for a in got for b in got if a < b and got[a] == got[b] and want[a] != want[b]]
    assert not invented
    text = dict(rows)
    direct = [
        (a, b)
        for a in want
        for b in want
        if a < b and want[a] == want[b] and near.weighted_jaccard(text[a] or "", text[b] or "", idf) >= 0.8
    ]
    lost = [pair for pair in direct if got[pair[0]] != got[pair[1]]]
    # A pair at the threshold is a candidate with a chance of 0.995, one that is more alike with a greater one.
    assert len(direct) > 100 and len(lost) <= 0.02 * len(direct)
    assert all(class_id == min(i for i in got if got[i] == class_id) for class_id in got.values())


def test_samples_agree_as_often_as_texts_are_similar():
    chance = random.Random(4)
    words = [f"v{n}" for n in range(400)]
    idf = np.ones(1 << near.BUCKET_BITS, np.float32) * 3
    texts = [" ".join(words)] + [edited(words, chance, e) for e in (4, 20, 60)]
    agreement = []
    for text in texts[1:]:
        both = [near.shingles_of(near.words_of(t)) for t in (texts[0], text)]
        samples = near.sampled(
            np.concatenate([s for s, _ in both]), np.concatenate([near.weights_of(s, c, idf) for s, c in both]), np.array([0, len(both[0][0])])
        )
        agreement.append(((samples[0] == samples[1]).mean(), near.weighted_jaccard(texts[0], text, idf)))
    assert all(abs(found - similar) < 0.2 for found, similar in agreement)


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7), (10, 11), (12, 11), (20, 21), (20, 21)]
    got = {r.node: r.class_id for r in near.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(1, 8), 1), 10: 10, 11: 10, 12: 10, 20: 20, 21: 20}


def test_edges(odd, odd_rows, no_rows):
    got = near.near_duplicates(odd.withColumnRenamed("lang", "class_id")).collect()
    found = {row.doc_id: row.class_id for row in got}
    assert len(got) == len({i for i, *_ in odd_rows}) and found[None] is None
    assert found[7] == found[1] == 1 and all(found[i] == i for i in (2, 3, 4, 5, 6, 9, 10, 11, 12))
    assert near.near_duplicates(no_rows).count() == 0


def test_texts_that_fail_their_leader_meet_the_others(spark, monkeypatch):
    """a ~ leader and a ~ b, but b is not similar to the leader: the link a ~ b must be found."""
    words = [f"v{n}" for n in range(300)]
    chance = random.Random(8)
    one = edited(words, chance, 6)
    other = edited(one.split(), chance, 6)
    docs = spark.createDataFrame([(1, " ".join(words)), (2, one), (3, other)], "doc_id bigint, text string")
    idf = near.inverse_frequencies(docs)
    similar = [near.weighted_jaccard(a, b, idf) for a, b in ((" ".join(words), one), (one, other), (" ".join(words), other))]
    threshold = (similar[2] + min(similar[:2])) / 2
    assert similar[2] < threshold < min(similar[:2])
    # One bucket holds all three, so that only the blocks can find the link.
    signatures = spark.createDataFrame([(i, [5]) for i in (1, 2, 3)], "doc_id bigint, bands array<bigint>")
    for size in (128, 1):
        monkeypatch.setattr(near, "BLOCK_TEXTS", size)
        links = near.linked(signatures, docs, idf, threshold)
        assert {row.class_id for row in near.components(links).collect()} == {1}


def test_blocks_of_one_class_do_not_meet(spark, monkeypatch):
    """Of a bucket all texts of different classes meet, and a large class costs its size for each other block."""
    monkeypatch.setattr(near, "BLOCK_TEXTS", 4)
    chance = random.Random(1)
    classes = [1] * 60 + [2] * 21 + [100 + n // 2 for n in range(15)]
    rows = [(0, 7, n, class_, chance.randrange(50), 9) for n, class_ in enumerate(classes)]
    rows += [(1, 7, n, 1 + n % 2, 5_000_000 if n < 3 else 10, 9) for n in range(9)]
    made = spark.createDataFrame(rows, "band int, key bigint, doc_id bigint, class_id bigint, bytes bigint, blocks int")
    groups = {}
    for row in near.paired(made).collect():
        groups.setdefault((row.band, row.key, row.pair), []).append((row.doc_id, row.class_id))
    for band, size in ((0, len(classes)), (1, 9)):
        met = {
            frozenset((a, b))
            for group, own in groups.items() if group[0] == band
            for a, one in own for b, other in own if one != other
        }
        label = {doc_id: class_ for b, _, doc_id, class_, *_ in rows if b == band}
        assert met == {frozenset((a, b)) for a in range(size) for b in range(a) if label[a] != label[b]}
    blocks = 15 + 6 + 4
    assert sum(len(own) for group, own in groups.items() if group[0] == 0) < blocks * len(classes)
    assert sum((doc_id, 1) in own for doc_id in (0,) for own in groups.values()) < blocks - 10


def test_blocks_compare_exactly(monkeypatch):
    chance = random.Random(2)
    base = [f"v{n % 90}" for n in range(150)]
    texts = [edited(base, chance, n % 9) for n in range(40)] + ["x " * 30, "x " * 31, "x y"]
    idf = np.random.default_rng(1).uniform(1, 4, 1 << near.BUCKET_BITS).astype(np.float32)
    similar = {(a, b) for b in range(len(texts)) for a in range(b) if near.weighted_jaccard(texts[a], texts[b], idf) >= 0.8}

    def united(links):
        label = list(range(len(texts)))
        for _ in label:
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        return label

    for size in (16_384, 7):
        monkeypatch.setattr(near, "COMPARED", size)
        links = near.joining(texts, np.arange(len(texts)), idf, 0.8)
        assert set(links) <= similar and united(links) == united(similar)
    assert near.joining(texts, np.zeros(len(texts), int), idf, 0.8) == []


def test_copies_do_not_move_the_weights(spark):
    chance = random.Random(8)
    texts = [" ".join(f"u{chance.randrange(900)}" for _ in range(40)) for _ in range(60)]
    few = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    more = [*enumerate(texts), *((100 + n, texts[0]) for n in range(80)), *((300 + n, texts[1].upper() + " ") for n in range(5))]
    more += [(None, texts[2]), (None, texts[2]), (7, texts[7]), (7, texts[7])]
    many = spark.createDataFrame(more, "doc_id bigint, text string")
    assert (near.inverse_frequencies(few) == near.inverse_frequencies(many)).all()
    # An edit is as similar to a text with many copies as to one without.
    one = edited(texts[0].split(), chance, 1)
    assert near.weighted_jaccard(texts[0], one, near.inverse_frequencies(few)) == near.weighted_jaccard(texts[0], one, near.inverse_frequencies(many))
