import dataclasses
import datetime as dt
import random

import pytest

from benchledger import queries
from benchledger.operators import chain_index, commits, reachability
from benchledger.plans import commands as cmd
from benchledger.session import new_path, settle
from tests.test_commits import LOG_SCHEMA, ancestors, commit_id, first_parents, frame, random_history

WALKS = "walk_id string, branch string, commit_id string"


def batch_of(spark, histories, cut):
    """Rows of the commits whose number lies in the range ``cut``."""
    ids = {(b, commit_id(i)) for b, (parents, _) in histories.items() for i in parents if cut[0] <= i < cut[1]}
    rows = [row for row in frame(spark, histories).collect() if (row.branch, row.commit_id) in ids]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def heads_at(spark, histories, end):
    rows = [(b, commit_id(min(end, len(parents)) - 1)) for b, (parents, _) in histories.items()]
    return spark.createDataFrame(rows, "branch string, head string")


def built(spark, histories, cuts, least_blocks=1):
    index = chain_index.ChainIndex(spark, new_path(spark, "index"))
    for batch, cut in enumerate(zip(cuts, cuts[1:], strict=False)):
        chain_index.append(index, batch_of(spark, histories, cut), heads_at(spark, histories, cut[1]), batch, least_blocks)
    return index


def walked(rows):
    found = {}
    for row in rows.collect():
        assert row.pos not in found.setdefault(row.walk_id, {})
        found[row.walk_id][row.pos] = row.commit_id
    return {walk: [at[pos] for pos in range(len(at))] for walk, at in found.items()}


@pytest.mark.parametrize(("cuts", "least_blocks"), [((0, 150), 6), ((0, 1, 90, 91, 150), 2)])
def test_index_equals_walking(spark, cuts, least_blocks):
    histories = {"a": random_history(1, 150), "b": random_history(2, 60)}
    index = built(spark, histories, cuts, least_blocks)
    chance = random.Random(5)
    starts = [(f"{b}-{i}", b, i) for b, (parents, _) in histories.items() for i in {len(parents) - 1, 0, *chance.sample(sorted(parents), 8)}]
    walks = spark.createDataFrame([(w, b, commit_id(i)) for w, b, i in starts], WALKS)
    got = walked(chain_index.stored_log(index, walks))
    assert got == {w: [commit_id(c) for c in first_parents(histories[b][0], i)] for w, b, i in starts}
    start = dt.datetime(2020, 1, 1, 6)
    cut = walked(chain_index.stored_log(index, walks, start))
    blocks = commits.commit_blocks(frame(spark, histories))
    assert cut == walked(commits.log_to_date(settle(commits.first_parent_log(blocks, walks), "chain"), start))
    # Depth counts the first parents down to the root, and a trunk has one commit at a depth.
    rows = index.commits().collect()
    for row in rows:
        assert row.depth == len(first_parents(histories[row.branch][0], next(i for i in histories[row.branch][0] if commit_id(i) == row.commit_id))) - 1
    assert len({(row.branch, row.trunk, row.depth) for row in rows}) == len(rows) == 210


def test_the_history_of_a_head_is_one_trunk(spark):
    """Side commits are older than the commits that the trunk goes on with, and newer ones, and never split it."""
    parents = {0: []} | {i: [i - 1] if i % 5 == 3 or i % 5 == 0 or i % 5 < 3 else [i - 2, i - 1] for i in range(1, 60)}
    times = {i: dt.datetime(2020, 1, 1) + dt.timedelta(minutes=i + (9 if i % 10 == 3 else 0)) for i in parents}
    index = built(spark, {"a": (parents, times)}, (0, 20, 41, 60))
    trunk = {commit_id(i) for i in first_parents(parents, 59)}
    assert len({row.trunk for row in index.commits().collect() if row.commit_id in trunk}) <= 3


def test_old_batches_are_not_read(spark, tmp_path):
    histories = {"a": random_history(3, 120)}
    parents, times = histories["a"]
    parents = {i: [p for p in above if i < 100 or p > 70] or [i - 1] for i, above in parents.items()} | {0: []}
    histories = {"a": (parents, times)}
    index = chain_index.ChainIndex(spark, str(tmp_path))
    for batch, cut in enumerate([(0, 40), (40, 70), (70, 100)]):
        chain_index.append(index, batch_of(spark, histories, cut), heads_at(spark, histories, cut[1]), batch)
    for batch in (0, 1):
        for part in tmp_path.glob(f"commits/batch={batch}/*.parquet"):
            part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
            part.write_bytes(b"not a table")
    chain_index.append(index, batch_of(spark, histories, (100, 120)), heads_at(spark, histories, 120), 3)
    rows = {row.commit_id: row.depth for row in index.commits([3]).collect()}
    assert rows == {commit_id(i): len(first_parents(parents, i)) - 1 for i in range(100, 120)}
    # Nor does a report of recent commits read them.
    walks = spark.createDataFrame([("w", "a", commit_id(119))], WALKS)
    recent = times[90] + dt.timedelta(hours=2)
    got = walked(chain_index.stored_log(index, walks, recent))["w"]
    chain = [commit_id(i) for i in first_parents(parents, 119)]
    assert got == chain[: len(got)] and 0 < len(got) < 50
    with pytest.raises(Exception, match="not a Parquet file|FAILED_READ_FILE"):
        chain_index.stored_log(index, walks).collect()


def test_a_repeated_batch_replaces_itself(spark):
    histories = {"a": random_history(4, 80)}
    index = built(spark, histories, (0, 50, 80))
    before = sorted(map(tuple, index.commits().select("commit_id", "trunk", "depth").collect()))
    chain_index.append(index, batch_of(spark, histories, (50, 80)), heads_at(spark, histories, 80), 1)
    assert sorted(map(tuple, index.commits().select("commit_id", "trunk", "depth").collect())) == before


def test_branches_that_leave_an_old_batch(spark):
    """Two batches later, two commits have a parent in the first one, whose trunk has gone on long since."""
    time = lambda i: dt.datetime(2020, 1, 1) + dt.timedelta(hours=i)
    index = chain_index.ChainIndex(spark, new_path(spark, "index"))
    batches = [
        ([("c1", []), ("c2", ["c1"]), ("c3", ["c2"])], "c3"),
        ([("c4", ["c3"])], "c4"),
        ([("d1", ["c2"]), ("e1", ["c2", "c4"]), ("d2", ["d1"]), ("f1", ["gone"])], "d2"),
        ([], "d2"),
        ([("d3", ["d2"]), ("e2", ["e1"]), ("g1", ["d2"])], "d3"),
    ]
    for batch, (rows, head) in enumerate(batches):
        new = spark.createDataFrame([("a", c, time(10 * batch + i), p) for i, (c, p) in enumerate(rows)] * 2, LOG_SCHEMA)
        chain_index.append(index, new, spark.createDataFrame([("a", head)], "branch string, head string"), batch)
    walks = spark.createDataFrame([(c, "a", c) for c in ("c4", "d3", "e2", "f1", "g1", "never")], WALKS)
    got = walked(chain_index.stored_log(index, walks))
    assert got == {
        "c4": ["c4", "c3", "c2", "c1"],
        "d3": ["d3", "d2", "d1", "c2", "c1"],
        "e2": ["e2", "e1", "c2", "c1"],
        "f1": ["f1"],
        "g1": ["g1", "d2", "d1", "c2", "c1"],
    }
    trunks = {row.commit_id: row.trunk for row in index.commits().collect()}
    assert trunks["c4"] == trunks["c1"] and trunks["d3"] == trunks["d1"] != trunks["g1"] and trunks["e2"] == trunks["e1"]


def test_commands_plan_and_report_from_the_index(spark):
    sf_dir = "/root/testdata/sf0.001"
    index, _ = queries._appended_index(spark, sf_dir)
    tables = queries._tables(spark, sf_dir)
    with_index = dataclasses.replace(tables, chain_index=index)
    sort = lambda df: sorted(map(tuple, df.collect()))
    assert sort(cmd.planned_commits(with_index).commits) == sort(cmd.planned_commits(tables).commits)
    columns = ["branch", "commit_id", "pos"]
    shown = [cmd.branch_commits(t, ["b1", "b7"], queries.REPORT_START).select(*columns) for t in (with_index, tables)]
    assert sort(shown[0]) == sort(shown[1]) and shown[0].count() > 0


def side_history(length):
    """A trunk of even commits and a side branch of odd ones that leaves it at the beginning."""
    parents = {0: [], 1: [0]} | {i: [i - 2] for i in range(2, length)}
    return parents, {i: dt.datetime(2020, 1, 1) + dt.timedelta(minutes=i) for i in parents}


def test_long_side_branch_takes_few_rounds(spark):
    parents, times = side_history(241)
    blocks = commits.commit_blocks(frame(spark, {"a": (parents, times)}), least_blocks=24)
    walks = spark.createDataFrame([("w", "a", commit_id(240))], WALKS)
    chain = settle(commits.first_parent_log(blocks, walks), "chain")
    asked = [("top", "w", "a", commit_id(239)), ("middle", "w", "a", commit_id(101)), ("trunk", "w", "a", commit_id(100)), ("gone", "w", "a", "gone")]
    ranges = spark.createDataFrame(asked, "range_id string, walk_id string, branch string, start_id string")
    positions, rounds = reachability.reached_positions(blocks, chain, ranges)
    assert blocks.rows.select("block").distinct().count() >= 20 and 1 <= rounds <= 6
    cuts = {row.range_id: row.cut for row in reachability.range_cuts(blocks, chain, ranges).collect()}
    assert cuts == {"top": 120, "middle": 120, "trunk": 70}
    assert reachability.reached_positions(blocks, chain, ranges.filter("range_id = 'trunk'"))[1] == 0
    assert positions.count() >= 3


@pytest.mark.parametrize("blocks", [1, 40])
def test_reachability_equals_brute_force(spark, blocks):
    histories = {"a": random_history(11, 160), "b": side_history(60), "c": random_history(12, 90)}
    cut = commits.commit_blocks(frame(spark, histories), least_blocks=blocks)
    chance = random.Random(blocks)
    walks, asked, expected = [], [], {}
    for b, (parents, _) in histories.items():
        for end in (len(parents) - 1, len(parents) - 8):
            walks.append((f"{b}-{end}", b, commit_id(end)))
            chain = [commit_id(i) for i in first_parents(parents, end)]
            for start in chance.sample(sorted(parents), 12):
                asked.append((f"{b}-{end}-{start}", f"{b}-{end}", b, commit_id(start)))
                met = [chain.index(commit_id(i)) for i in ancestors(parents, start) if commit_id(i) in chain]
                if met:
                    expected[f"{b}-{end}-{start}"] = min(met)
    chain = settle(commits.first_parent_log(cut, spark.createDataFrame(walks, WALKS)), "chain")
    ranges = spark.createDataFrame(asked, "range_id string, walk_id string, branch string, start_id string")
    got = {row.range_id: row.cut for row in reachability.range_cuts(cut, chain, ranges).collect()}
    assert got == expected


def test_the_blocks_of_an_index_can_be_walked(spark):
    histories = {"a": random_history(7, 60)}
    blocks = built(spark, histories, (0, 40, 60)).blocks()
    walks = spark.createDataFrame([("w", "a", commit_id(59))], WALKS)
    got = walked(commits.first_parent_log(blocks, walks))["w"]
    assert got == [commit_id(i) for i in first_parents(histories["a"][0], 59)]
