import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from benchledger.llm import simhash


def fingerprint_by_hand(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components_by_hand(rows, distance=2):
    """All pairs; rows are (doc_id, fingerprint)."""
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] ^ rows[b][1]).bit_count() <= distance:
                one, other = sorted((root(a), root(b)))
                label[other] = one
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(doc_id, f"{value:016x}", least.get(root(i))) for i, (doc_id, value) in enumerate(rows)]


def order(row):
    return tuple((value is None, value or 0) if not isinstance(value, str) else value for value in row)


def test_fingerprints(spark, odd, odd_rows, monkeypatch):
    texts = [(i, text) for i, text, *_ in odd_rows]
    want = sorted(((i, f"{fingerprint_by_hand(text):016x}") for i, text in texts), key=order)
    for chunk in (65_536, 7):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        got = simhash.fingerprints(odd).select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0")).collect()
        assert sorted(map(tuple, got), key=order) == want


def test_components_of_texts(spark):
    chance = random.Random(3)
    rows = []
    for _ in range(25):
        words = [f"v{chance.randrange(400)}" for _ in range(chance.choice([4, 60, 300]))]
        rows += [" ".join(words)] * chance.choice([1, 4])
        for edits in (1, 1, 2, 5):
            near = list(words)
            for _ in range(edits):
                near[chance.randrange(len(near))] = f"w{chance.randrange(10**6)}"
            rows.append(" ".join(near).upper())
    rows += [None, "", " \t\n", "a", "A", "a b", "a b c", "a  b\nc", "日本 é", "日本  é"]
    rows = [*enumerate(rows), (5, "five again"), (5, "five again"), (None, rows[0]), (None, "alone without an id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("Fingerprint_", F.lit(1)).withColumn("value", F.lit(2))
    want = components_by_hand([(i, fingerprint_by_hand(text)) for i, text in rows])
    assert len({row[2] for row in want}) < len(want) - 20
    got = simhash.simhash_components(docs).collect()
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def planted(chance):
    """Evenly spread values, values with correlated bits, a dense cluster, chains of single flips."""
    flip = lambda value, bits: value ^ sum(1 << bit for bit in chance.sample(range(64), bits))
    values = [chance.getrandbits(64) for _ in range(300)]
    values += [flip(value, chance.choice([1, 2, 3])) for value in values[:200]]
    values += [sum((1 << bit) for bit in range(64) if chance.random() < 0.5) & ~0xFFFF | (0xFFFF if chance.random() < 0.9 else 0) for _ in range(200)]
    centre = chance.getrandbits(64)
    values += [flip(centre, chance.choice([0, 1, 2, 4, 6])) for _ in range(250)]
    step = chance.getrandbits(64)
    for _ in range(40):
        step = flip(step, 2)
        values.append(step)
    return sorted({*values, 0, 1, 3, 2**64 - 1, 2**63})


@pytest.mark.parametrize(("distance", "parts"), [(2, None), (2, 3), (2, 2), (2, 1), (1, 2), (3, 3), (0, 1), (2, 5)])
def test_links_connect_what_all_pairs_connect(spark, distance, parts):
    values = planted(random.Random(distance))
    rows = [(value - (value >> 63 << 64),) for value in values]
    different = spark.createDataFrame(rows, "fingerprint bigint").repartition(3)
    costs = simhash.costs_of(different, distance, parts)
    got = simhash.links(simhash.held_and_asked(different, costs), distance).collect()
    label = {value: value for (value,) in rows}
    for _ in range(200):
        before = dict(label)
        for a, b in got:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    want = components_by_hand([(n, value) for n, value in enumerate(values)], distance)
    classes, mine = {}, {}
    for (value,), (n, _, component) in zip(rows, want, strict=True):
        classes.setdefault(component, set()).add(n)
        mine.setdefault(label[value], set()).add(n)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, mine.values()))


def test_small_blocks_and_batches_give_the_same(spark, monkeypatch):
    values = planted(random.Random(9))
    rows = [(n, value - (value >> 63 << 64)) for n, value in enumerate(values)]
    different = spark.createDataFrame(rows, "doc_id bigint, fingerprint bigint")
    monkeypatch.setattr(simhash, "fingerprints", lambda documents: documents)
    monkeypatch.setattr(simhash, "BLOCK", 8)
    monkeypatch.setattr(simhash, "PAIRS", 10)
    monkeypatch.setattr(simhash, "EMITTED", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for parts in (3, 2):
            got = simhash.simhash_components(different, parts=parts).collect()
            assert sorted(map(tuple, got)) == components_by_hand([(n, value) for n, value in enumerate(values)])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_thresholds_cost_least_and_add_up(spark):
    values = planted(random.Random(4))
    different = spark.createDataFrame([(value - (value >> 63 << 64),) for value in values], "fingerprint bigint")
    for parts in (1, 2, 3, 4):
        costs = simhash.costs_of(different, 2, parts)
        own = np.array(values, np.uint64)
        table = np.stack([costs.of(own, part) for part in range(parts)])
        chosen = costs.thresholds(own)
        assert (chosen.sum(axis=0) == 2 - parts + 1).all() and chosen.min() >= -1
        best = np.full(len(own), np.inf)
        for choice in np.ndindex(*[4] * parts):
            if sum(choice) - parts == 2 - parts + 1:
                best = np.minimum(best, sum(table[part, level] for part, level in enumerate(choice)))
        spent = sum(table[part, chosen[part] + 1, np.arange(len(own))] for part in range(parts))
        assert np.allclose(spent, best)


def test_correlated_bits_come_together():
    chance = np.random.default_rng(1)
    bits = chance.integers(0, 2, (5000, 64))
    for first in (3, 20, 41):
        bits[:, first + 7] = bits[:, first]
        bits[:, first + 11] = 1 - bits[:, first]
    groups = simhash.grouped_bits(5000, bits.T @ bits, 3)
    assert sorted(bit for group in groups for bit in group) == list(range(64)) and {len(g) for g in groups} == {21, 22}
    home = {bit: n for n, group in enumerate(groups) for bit in group}
    assert all(home[first] == home[first + 7] == home[first + 11] for first in (3, 20, 41))


def test_parts_follow_the_number_of_fingerprints():
    parts = [simhash.usual_parts(10**power, 2) for power in range(15)]
    assert parts == sorted(parts, reverse=True) and parts[0] == 3 and parts[-1] == 1


def test_edges(odd, no_rows):
    rows = simhash.simhash_components(odd.withColumnRenamed("lang", "component_id").withColumnRenamed("source", "least_id")).collect()
    assert len(rows) == odd.count()
    found = {row.doc_id: row.component_id for row in rows}
    assert found[3] == found[4] == found[5] == found[9] == 3 and found[1] == found[7] == 1
    assert simhash.simhash_components(no_rows).count() == 0
    assert simhash.simhash_components(no_rows).columns == ["doc_id", "fingerprint", "component_id"]
