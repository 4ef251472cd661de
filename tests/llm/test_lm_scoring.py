import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from benchledger.llm import lm_scoring

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def middle(count):
    return float(count) if count < 2 else 1.5 * 2 ** int(math.log2(count)) - 0.5


def check(got, rows):
    counts, pairs = Counter(), Counter()
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in rows}
    for i, text in rows:
        if not held[i]:
            own = tokens(text)
            counts.update(own)
            pairs.update(zip([None, *own[:-1]], own))
    n, v = sum(counts.values()), len(counts)
    want = {}
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        share, score = lm_scoring.PAIR_SHARE, 0.0
        for before, token in zip([None, *own[:-1]], own):
            pair = pairs[before, token] if pairs[before, token] >= lm_scoring.LEAST_PAIRS else 0
            follows = min(1.0, middle(pair) / max(middle(counts[before]), 1)) if counts[before] else 0.0
            score += math.log10((1 - share) * (middle(counts[token]) + 1) / (n + v + 1) + share * follows)
        want.setdefault(i, []).append((held[i], len(own), sum(counts[t] > 0 for t in own), n, base, score))
    assert len(got) == len(rows)
    for row in got:
        expected = want[row.doc_id][0]
        assert tuple(row)[1:5] == expected[:4]
        assert row.base_score == pytest.approx(expected[4], rel=1e-9, abs=1e-9)
        # False positives only raise a score, save that a too frequent context lowers what follows it.
        assert abs(row.score - expected[5]) <= 0.25 * row.n_tokens + 0.5


def test_scores(odd, odd_rows, documents, no_rows):
    check(lm_scoring.lm_scores(odd).collect(), [(i, t) for i, t, *_ in odd_rows])
    check(lm_scoring.lm_scores(documents).collect(), [(r.doc_id, r.text) for r in documents.collect()])
    assert lm_scoring.lm_scores(no_rows).count() == 0


def scores_by_hand(rows):
    """From exact counts of all words and pairs by their hashes, a filter part per segment, and one probe per token."""
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in rows}
    words, pairs = Counter(), Counter()
    for i, text in rows:
        own = lm_scoring.tokens_of(text or "")
        if not held[i]:
            words.update(own.tolist())
            pairs.update(lm_scoring.pairs_of(own).tolist())
    n, v = sum(words.values()), len(words)

    def levels(counted):
        hashes = np.array(sorted(counted), np.uint64)
        counts = np.array([counted[h] for h in hashes.tolist()], np.int64)
        segment = lm_scoring.segment_of(hashes, lm_scoring.SEGMENTS)
        parts = {s: lm_scoring.filter_part(hashes[segment == s], counts[segment == s]) for s in set(segment.tolist())}
        parts |= {s: lm_scoring.filter_part(hashes[:0], counts[:0]) for s in range(lm_scoring.SEGMENTS) if s not in parts}
        return lm_scoring.Filter.of(parts, lm_scoring.SEGMENTS)

    word_filter, pair_filter = levels(words), levels(pairs)
    count = lambda found, value: float(found.counts(np.array([value], np.uint64))[0])
    scores = {}
    for i, text in rows:
        own = lm_scoring.tokens_of(text or "")
        total = 0.0
        for before, token, pair in zip([lm_scoring.END, *own[:-1]], own, lm_scoring.pairs_of(own), strict=True):
            alone = min(1.0, (count(word_filter, token) + 1) / (n + v + 1))
            context = count(word_filter, before)
            follows = min(1.0, count(pair_filter, pair) / max(context, 1)) if context else 0.0
            total += math.log10((1 - lm_scoring.PAIR_SHARE) * alone + lm_scoring.PAIR_SHARE * follows)
        scores.setdefault(i, []).append(total)
    return scores


@pytest.mark.parametrize("filter_bytes", [lm_scoring.FILTER_BYTES, 0])
def test_scores_by_the_same_probes(odd, documents, filter_bytes):
    """The filter broadcast, and probed in parts."""
    for docs in (odd.filter("doc_id <> 6 or doc_id is null"), documents.filter("n_chars < 1500")):
        want = scores_by_hand([(row.doc_id, row.text) for row in docs.collect()])
        got = lm_scoring.lm_scores(docs, filter_bytes).collect()
        assert sum(map(len, want.values())) == len(got) > 10
        for row in got:
            assert row.score == pytest.approx(want[row.doc_id][0], rel=1e-6, abs=1e-6)


def test_both_layouts_give_the_same(documents, no_rows):
    one, other = (sorted(map(tuple, lm_scoring.lm_scores(documents, size).collect())) for size in (lm_scoring.FILTER_BYTES, 0))
    assert one == other and len(one) == 200
    assert lm_scoring.lm_scores(no_rows, 0).count() == 0


def test_the_bound_of_the_filter_holds():
    chance = np.random.default_rng(8)
    for size in (0, 1, 10, 1000, 40_000):
        hashes = np.unique(chance.integers(0, 1 << 63, size, dtype=np.uint64))
        counts = (chance.pareto(1.0, len(hashes)) + 1).astype(np.int64)
        assert len(lm_scoring.filter_part(hashes, counts)) <= lm_scoring.most_filter_bytes(int(counts.sum()), 1)


def test_blocks_are_cut_by_tokens(monkeypatch):
    # Blocks are cut in the workers, so the bound is bound into the function that they get.
    batches = [type("Batch", (), {"column": lambda self, name: type("C", (), {"to_pylist": lambda s: ["a b", "c " * 9, "d"]})()})()]
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", 5)
    cut = list(lm_scoring.in_blocks(batches, []))
    assert [[row[-1] for row in rows] for rows, _ in cut] == [[3], [10], [2]]


def test_filter_never_misses_and_rarely_invents():
    chance = np.random.default_rng(3)
    hashes = chance.integers(0, 1 << 63, 30_000, dtype=np.uint64) * np.uint64(2)
    counts = (chance.pareto(1.0, len(hashes)) + 1).astype(np.int64)
    segments = 7
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    parts = {s: lm_scoring.filter_part(hashes[a:b], counts[a:b]) for s, a, b in lm_scoring.ranges_of(hashes, segments)}
    found = lm_scoring.Filter.of(parts, segments).counts(hashes)
    least = np.array([middle(c) for c in counts])
    assert (found >= least).all() and (found > least).mean() < 0.15
    other = chance.integers(0, 1 << 63, 30_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    assert (lm_scoring.Filter.of(parts, segments).counts(other) > 0).mean() < 0.1


def test_only_segments_with_entries_are_sent(spark, documents):
    assert lm_scoring.ranges_of(np.zeros(0, np.uint64), 9) == []
    hashes = np.sort(np.random.default_rng(4).integers(0, 1 << 64, 300, dtype=np.uint64))
    ranges = lm_scoring.ranges_of(hashes, 1000)
    assert len(ranges) <= 300 and [a for _, a, _ in ranges][1:] == [b for *_, b in ranges][:-1] and ranges[-1][2] == 300
    assert all((lm_scoring.segment_of(hashes[a:b], 1000) == s).all() for s, a, b in ranges)
    few = documents.limit(3).withColumn("held_out", lm_scoring.F.lit(False))
    blocks = lm_scoring.blocks_of(few)
    entries = sum(len(row.listed) // 8 for row in blocks.collect())
    words = lm_scoring.word_counts(blocks, 100_000).filter("block >= 0")
    assert 0 < words.count() <= entries


def test_word_filter_grows_with_its_entries(documents):
    """All words are found, few of them too often."""
    chance = np.random.default_rng(5)
    hashes = np.unique(chance.integers(0, 1 << 63, 60_000, dtype=np.uint64))
    counts = (chance.pareto(1.0, len(hashes)) + 1).astype(np.int64)
    part = lm_scoring.filter_part(hashes, counts)
    levels = np.log2(counts).astype(np.int64) + 1
    assert len(part) >= levels.sum()
    found = lm_scoring.Filter.of({0: part}, 1).levels(hashes)
    assert (found >= levels).all() and (found > levels).mean() < 0.05

    rows = [(r.doc_id, r.text) for r in documents.collect()]
    counted = Counter(t for i, text in rows if zlib.crc32(str(i).encode()) % 7 != 2 for t in tokens(text))
    blocks = lm_scoring.blocks_of(documents.withColumn("held_out", lm_scoring.remainder(lm_scoring.F.col("doc_id"), 7) == 2))
    words = lm_scoring.word_counts(blocks, lm_scoring.segments_of(lm_scoring.tokens_in(blocks))).filter("block >= 0").collect()
    exact = np.concatenate([np.frombuffer(zlib.decompress(row["data"]), np.int64) for row in words])
    levels = np.concatenate([np.frombuffer(zlib.decompress(row["levels"]), np.uint8) for row in words])
    want = np.where(exact > 0, np.log2(np.maximum(exact, 1)).astype(np.int64) + 1, 0)
    assert exact.max() == max(counted.values())
    assert (levels >= want).all() and (levels > want).mean() < 0.05


def test_pairs_of_any_count_stay_at_any_setting(spark, documents):
    hashes = np.unique(np.random.default_rng(2).integers(0, 1 << 63, 5_000, dtype=np.uint64)) & lm_scoring.HIGH_48
    assert (lm_scoring.unpacked(lm_scoring.packed(hashes), len(hashes)) == hashes).all()
    assert not len(lm_scoring.unpacked(lm_scoring.packed(hashes[:0]), 0))
    assert lm_scoring.LEAST_PAIRS == 1
    rows = [(i, f"w{i} x{i} y{i} z{i}") for i in range(40)]
    got = lm_scoring.lm_scores(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    for row in got:
        if not row.held_out:
            # Each pair stands once, so a word follows the word before it for certain.
            assert row.score > 5 * math.log10(lm_scoring.PAIR_SHARE) - 2.5

    def scores():
        return sorted((r.doc_id, r.base_score, r.score) for r in lm_scoring.lm_scores(documents).collect())

    few, partitions = scores(), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert scores() == few
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
