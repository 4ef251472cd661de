import itertools

import pytest
import xxhash

from benchledger.llm import mixing
from tests.llm.conftest import SCHEMA, prose


def filled(budget, children):
    """children: name -> (weight, limit). Fills the children step by step."""
    got, open_, left = {}, dict(children), budget
    while open_:
        total = sum(weight for weight, _ in open_.values())
        full = {n: limit for n, (weight, limit) in open_.items() if limit <= left * weight / total}
        if not full:
            return got | {n: left * weight / total for n, (weight, _) in open_.items()}
        first = min(full, key=lambda n: (full[n] / open_[n][0], n))
        got[first] = full[first]
        left -= full[first]
        del open_[first]
    return got


def quotas_by_hand(leaves, weights, budget, epochs):
    def walk(prefix, amount):
        if len(prefix) == 3:
            return {prefix: amount}
        below = sorted({path[: len(prefix) + 1] for path in leaves if path[: len(prefix)] == prefix})
        limit = lambda node: float(epochs * sum(n for path, n in leaves.items() if path[: len(node)] == node))
        shares = filled(amount, {node: (weights.get(node, 1.0), limit(node)) for node in below})
        return {path: n for node in below for path, n in walk(node, shares[node]).items()}

    return walk((), float(budget))


LEAVES = {("a", "en", "x"): 100, ("a", "en", "y"): 10, ("a", "de", "x"): 50, ("b", "en", "x"): 20, ("b", "de", "z"): 5, ("c", "", ""): 1000}
WEIGHTS = {("a",): 5.0, ("b",): 4.0, ("a", "en"): 3.0, ("a", "en", "y"): 9.0}


@pytest.mark.parametrize("budget", [0, 30, 300, 700, 2000, 10_000])
def test_quotas(spark, budget):
    leaves = spark.createDataFrame([(*path, n) for path, n in LEAVES.items()], "_domain string, _lang string, _source string, _tokens bigint")
    from pyspark.sql import functions as F

    got = {tuple(row[:3]): row._quota for row in mixing.quotas(leaves, WEIGHTS, F.lit(budget), 2).select(*mixing.PATH, "_quota").collect()}
    want = quotas_by_hand(LEAVES, WEIGHTS, min(budget, 2 * sum(LEAVES.values())), 2)
    assert {path: pytest.approx(n, abs=1.001) for path, n in want.items()} == got
    assert sum(got.values()) <= budget


def key(epoch, doc_id, seed):
    """What Spark's xxhash64 gives for (int seed, bigint epoch, string id)."""
    state = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
    state = xxhash.xxh64_intdigest(epoch.to_bytes(8, "little"), state)
    value = xxhash.xxh64_intdigest(str("" if doc_id is None else doc_id).encode(), state)
    return value - (1 << 64) if value >> 63 else value


def test_whole_epochs_and_prefix(spark):
    docs = [(n, prose(n, n % 17), "en", f"src{n % 3}", 1) for n in range(400)]
    frame = spark.createDataFrame(docs, SCHEMA)
    rows = mixing.mix(frame, {("domain0",): 2.0}, budget_share=0.7, epochs=3, seed=5).collect()
    chosen = {}
    for row in rows:
        chosen.setdefault(row.epoch, set()).add(row.doc_id)
    from pyspark.sql import functions as F

    leaf = {r.doc_id: tuple(r)[1:] for r in mixing.with_leaf(frame).select("doc_id", *mixing.PATH, "_tokens").collect()}
    leaves = {}
    for *path, n in leaf.values():
        leaves[tuple(path)] = leaves.get(tuple(path), 0) + n
    made = spark.createDataFrame([(*path, n) for path, n in leaves.items()], "_domain string, _lang string, _source string, _tokens bigint")
    total = sum(leaves.values())
    for row in mixing.quotas(made, {("domain0",): 2.0}, F.lit(total * 0.7), 3).collect():
        path = (row._domain, row._lang, row._source)
        own = [i for i, (*p, _) in leaf.items() if tuple(p) == path]
        whole, rest = divmod(row._quota, row._tokens)
        for epoch in range(whole):
            assert set(own) <= chosen[epoch]
        prefix, used = set(), 0
        for order, group in itertools.groupby(sorted(own, key=lambda i: key(whole, i, 5)), key=lambda i: key(whole, i, 5)):
            group = list(group)
            used += sum(leaf[i][3] for i in group)
            if used > rest:
                break
            prefix |= set(group)
        assert chosen.get(whole, set()) & set(own) == prefix
    assert sum(row.n_tokens for row in rows) <= 0.7 * total


def test_edges(odd, no_rows, odd_rows):
    assert mixing.mixture(no_rows).count() == 0
    assert mixing.mix(odd, budget_share=0.0).filter("n_tokens > 0").count() == 0
    everything = mixing.mix(odd.withColumnRenamed("n_chars", "_tokens"), budget_share=1.0, epochs=1).collect()
    assert sum(row.n_tokens for row in everything) > 30_000
    twice = mixing.mix(odd, budget_share=2.0, epochs=2)
    assert twice.filter("doc_id = 7").count() == 4 and set(twice.columns) >= {"text", "domain", "epoch"}
