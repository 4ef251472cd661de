import datetime as dt
import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from benchledger.operators import commits

LOG_SCHEMA = "branch string, commit_id string, commit_time timestamp_ntz, parents array<string>"


def commit_id(i):
    return hashlib.md5(str(i).encode()).hexdigest()


def random_history(seed, size):
    """A DAG with merges, long side branches and clocks that run backwards now and then."""
    rng = random.Random(seed)
    parents = {0: []}
    for i in range(1, size):
        first = max(0, i - rng.choice([1, 1, 1, 2, 3, 7]))
        others = [rng.randrange(i)] if rng.random() < 0.3 else []
        parents[i] = [first, *[o for o in others if o != first]]
    times = {i: dt.datetime(2020, 1, 1) + dt.timedelta(minutes=10 * i + rng.randrange(-60, 60)) for i in parents}
    return parents, times


def frame(spark, histories):
    rows = [
        (branch, commit_id(i), times[i], [commit_id(p) for p in parents[i]])
        for branch, (parents, times) in histories.items()
        for i in parents
    ]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def first_parents(parents, start):
    chain = [start]
    while parents[chain[-1]]:
        chain.append(parents[chain[-1]][0])
    return chain


def ancestors(parents, start):
    seen, todo = set(), [start]
    while todo:
        here = todo.pop()
        if here not in seen:
            seen.add(here)
            todo.extend(parents[here])
    return seen


@pytest.mark.parametrize("block_rows", [7, 40, 10_000])
def test_walks_and_ranges_match_brute_force(spark, block_rows):
    histories = {"a": random_history(1, 150), "b": random_history(2, 60)}
    log = frame(spark, histories)
    blocks = commits.commit_blocks(log, block_rows)
    heads = {"a": 149, "b": 59}
    walks = spark.createDataFrame(
        [(f"{b}-{end}", b, commit_id(end)) for b in heads for end in (heads[b], heads[b] - 11)],
        "walk_id string, branch string, commit_id string",
    )
    chain = commits.first_parent_log(blocks, walks).persist()
    found = {}
    for row in chain.collect():
        found.setdefault(row.walk_id, {})[row.pos] = row.commit_id
    for b, (parents, _) in histories.items():
        for end in (heads[b], heads[b] - 11):
            expected = [commit_id(i) for i in first_parents(parents, end)]
            got = found[f"{b}-{end}"]
            assert [got[pos] for pos in range(len(got))] == expected

    rng = random.Random(3)
    asked, expected = [], {}
    for b, (parents, _) in histories.items():
        starts = [heads[b], 0, *rng.sample(range(heads[b]), 6)]
        for start in starts:
            range_id = f"{b}-{start}"
            asked.append((range_id, f"{b}-{heads[b]}", b, commit_id(start)))
            excluded = ancestors(parents, start)
            expected[range_id] = {commit_id(i) for i in first_parents(parents, heads[b]) if i not in excluded}
    asked_type = "range_id string, chain_id string, branch string, start_id string"
    ranges = spark.createDataFrame(asked, asked_type).withColumn("end_pos", F.lit(0))
    got = {range_id: set() for range_id in expected}
    for row in commits.first_parent_range(blocks, chain, ranges).collect():
        got[row.range_id].add(row.commit_id)
    assert got == expected
    chain.unpersist()


def test_walk_ends_where_the_log_ends(spark):
    rows = [("a", "c2", dt.datetime(2020, 1, 2), ["c1"]), ("a", "c1", dt.datetime(2020, 1, 1), ["gone"])]
    blocks = commits.commit_blocks(spark.createDataFrame(rows, LOG_SCHEMA), 1)
    walks = spark.createDataFrame([("w", "a", "c2")], "walk_id string, branch string, commit_id string")
    chain = commits.first_parent_log(blocks, walks)
    assert sorted((r.pos, r.commit_id) for r in chain.collect()) == [(0, "c2"), (1, "c1")]
    # Nothing is reachable from a start outside the log, so nothing is cut.
    ranges = spark.createDataFrame([(1, "w", "a", "gone", 0)], "range_id int, chain_id string, branch string, start_id string, end_pos int")
    assert commits.first_parent_range(blocks, chain, ranges).count() == 2


@pytest.mark.parametrize("block_rows", [9, 10_000])
def test_lines_of_a_branch_share_its_chain(spark, block_rows):
    """Lines that end anywhere on a branch's history add no chain rows; others add their own walk."""
    parents, times = random_history(5, 120)
    blocks = commits.commit_blocks(frame(spark, {"a": (parents, times)}), block_rows)
    refs = spark.createDataFrame([("a", commit_id(119))], "branch string, head string")
    trunk = first_parents(parents, 119)
    off = next(i for i in range(100, 0, -1) if i not in trunk)
    ends = [119, trunk[3], trunk[10], trunk[20], off]
    lines = [(n, "a", commit_id(end), commit_id(trunk[25])) for n, end in enumerate(ends)]
    ranges = spark.createDataFrame(lines, "config_id int, branch string, walk_id string, start_id string")
    chain, shared = commits.shared_chains(blocks, ranges, refs)
    assert chain.count() == len(trunk) + len(first_parents(parents, off))
    got = {}
    for row in commits.first_parent_range(blocks, chain, shared.withColumnRenamed("config_id", "range_id")).collect():
        got.setdefault(row.range_id, {})[row.pos] = row.commit_id
    excluded = ancestors(parents, trunk[25])
    for n, end in enumerate(ends):
        wanted = [commit_id(i) for i in first_parents(parents, end) if i not in excluded]
        assert [got.get(n, {})[pos] for pos in range(len(wanted))] == wanted and len(got.get(n, {})) == len(wanted)


def test_a_commit_that_stands_twice_counts_once(spark):
    rows = [("a", "c2", dt.datetime(2020, 1, 2), ["c1"]), ("a", "c1", dt.datetime(2020, 1, 1), [])]
    blocks = commits.commit_blocks(spark.createDataFrame(rows * 2, LOG_SCHEMA), 1)
    walks = spark.createDataFrame([("w", "a", "c2")], "walk_id string, branch string, commit_id string")
    assert sorted(r.pos for r in commits.first_parent_log(blocks, walks).collect()) == [0, 1]


def test_log_to_date_keeps_the_first_old_commit(spark):
    base = dt.datetime(2020, 1, 1)
    rows = [("w", "a", f"c{i}", base + dt.timedelta(seconds=s), i) for i, s in enumerate((10, 5, 8))]
    chain = spark.createDataFrame(rows, "walk_id string, branch string, commit_id string, commit_time timestamp_ntz, pos bigint")
    kept = commits.log_to_date(chain, base + dt.timedelta(seconds=6, milliseconds=700))
    assert sorted(r.commit_id for r in kept.collect()) == ["c0", "c1"]
    assert commits.log_to_date(chain, base).count() == 3


def test_sampling_keeps_the_oldest(spark):
    ids = ["8000001a", "ffffffff", "8000000a", "8000001b"]
    log = spark.createDataFrame([(1, c, i) for i, c in enumerate(ids)] + [(2, "ffffffff", 0)], "k int, commit_id string, pos bigint")
    rates = spark.createDataFrame([(1, 0.5), (2, 0.0)], "k int, sampling double")
    kept = {(r.k, r.commit_id) for r in commits.sample_log(log, rates, "k").collect()}
    assert kept == {(1, "8000000a"), (1, "8000001b"), (2, "ffffffff")}


def test_revision_lookup(spark):
    log = spark.createDataFrame(
        [("a", "1234567aa", None, []), ("a", "1234567ab", None, []), ("a", "7654321aa", None, []), ("b", "1234567aa", None, [])],
        LOG_SCHEMA,
    )
    refs = spark.createDataFrame([("a", "7654321aa")], "branch string, head string")
    wanted = spark.createDataFrame(
        [("a", "HEAD"), ("b", "HEAD"), ("a", "7"), ("a", "7654"), ("a", "12"), ("a", "8"), ("a", "1234567"), ("a", "1234567ab"), ("b", "1234567"), ("a", "7777777")],
        "branch string, revision string",
    )
    found = {(r.branch, r.revision): (r.resolution, r.resolved_id) for r in commits.resolve_revisions(wanted, log, refs).collect()}
    assert found == {
        ("a", "HEAD"): ("resolved", "7654321aa"),
        ("b", "HEAD"): ("unknown", None),
        ("a", "7"): ("resolved", "7654321aa"),
        ("a", "7654"): ("resolved", "7654321aa"),
        ("a", "12"): ("ambiguous", None),
        ("a", "8"): ("unknown", None),
        ("a", "1234567"): ("ambiguous", None),
        ("a", "1234567ab"): ("resolved", "1234567ab"),
        ("b", "1234567"): ("resolved", "1234567aa"),
        ("a", "7777777"): ("unknown", None),
    }


def test_missing_branches_is_a_bag_difference(spark):
    configured = spark.createDataFrame([("a",), ("a",), ("b",)], "branch string")
    refs = spark.createDataFrame([("refs/heads/a",), ("refs/heads/c",)], "ref_name string")
    assert sorted(r.branch for r in commits.missing_branches(configured, refs).collect()) == ["a", "b"]


def test_blocks_are_shortened_where_they_are_dealt_out(spark):
    histories = {"a": random_history(11, 150), "b": random_history(12, 60)}
    rows = commits.commit_blocks(frame(spark, histories), 20).rows.collect()
    at = {(row.branch, row.commit_id): row for row in rows}
    assert len(at) == len(rows) == 210 and len({row.block for row in rows}) >= 8
    for row in rows:
        here, hops = row, 0
        while here.parents and (up := at[row.branch, here.parents[0]]).block == row.block:
            here, hops = up, hops + 1
            assert hops > 1 or row.up == up.row
        assert (row.last, row.hops) == (here.row, hops) and (row.up is None) == (hops == 0)
        assert row.out_id == (here.parents[0] if here.parents else None)


def test_a_commit_that_the_log_holds_twice_counts_once(spark):
    rows = frame(spark, {"a": random_history(13, 30)}).collect()
    later = [(r.branch, r.commit_id, r.commit_time + dt.timedelta(days=9), []) for r in rows[::3]]
    log = spark.createDataFrame([*map(tuple, rows), *later], LOG_SCHEMA)
    found = commits.commit_blocks(log, 7).rows.select("branch", "commit_id", "commit_time", "parents").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, rows))


def test_a_block_in_pieces_is_placed_without_copying_the_rest():
    ids = [f"c{i}" for i in range(9)]
    columns = {"branch": ["a"] * 5 + ["b"] * 4, "commit_id": ids, "commit_time": list(range(9)), "_parent0": [None, *ids[:8]]}
    whole = pa.table(columns)
    pieces = pa.concat_tables([whole.slice(0, 3), whole.slice(3, 4), whole.slice(7)])
    placed = commits._placed(pieces)
    assert placed["commit_time"].num_chunks == 3
    assert placed.equals(commits._placed(whole))
    # A branch is followed on its own; its first commit goes on outside.
    assert placed["last"].to_pylist() == [0] * 5 + [5] * 4
    assert placed["hops"].to_pylist() == [0, 1, 2, 3, 4, 0, 1, 2, 3]
    assert placed["out_id"].to_pylist() == [None] * 5 + ["c4"] * 4
