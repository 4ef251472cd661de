"""What a commit reaches through any of its parents, on a log that is cut into blocks.

Each block is closed once, for all that is asked: a commit at its border (a parent of a commit in another
block) reaches these border commits of other blocks, and the chain at this position. Border commits are
few, and the graph that they form is closed by doubling: after round k all that lies within 2 ** k - 1 steps
is known. So the rounds follow the logarithm of the blocks that a side branch crosses, and the log itself
is read twice, however long the branch is.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchledger.session import settle

if TYPE_CHECKING:
    from benchledger.operators.commits import CommitBlocks

NODE = ["walk_id", "branch", "commit_id"]
GROUP = ["block", "branch", "walk_id"]


def closed_block(ids: pd.Index, parents: list, on_chain: np.ndarray, entered: np.ndarray) -> list[tuple]:
    """(commit, outside commit or None, position or None) for each entered commit of one block.

    Every commit gets the set of outside commits that it reaches, as bits of a number, and the least chain
    position, from those of its parents; so the work follows the commits visited and not the pairs. What lies
    behind a chain commit is on the chain or has been passed by it, so the search ends there.
    """
    sizes = np.fromiter((len(p) for p in parents), np.int64, len(parents))
    ends = np.cumsum(sizes)
    above = np.concatenate([np.asarray(p, object) for p in parents]) if len(parents) else np.zeros(0, object)
    inside = ids.get_indexer(above) if len(above) else np.zeros(0, np.int64)
    outside: dict[str, int] = {}
    reach: dict[int, tuple[int, float]] = {}
    for first in entered.tolist():
        todo = [first]
        while todo:
            here = todo[-1]
            if here in reach:
                todo.pop()
                continue
            if not np.isnan(on_chain[here]):
                reach[here] = 0, float(on_chain[here])
                todo.pop()
                continue
            span = range(int(ends[here] - sizes[here]), int(ends[here]))
            open_ = [int(inside[i]) for i in span if inside[i] >= 0 and int(inside[i]) not in reach]
            if open_:
                todo.extend(open_)
                continue
            bits, least = 0, np.inf
            for i in span:
                if inside[i] < 0:
                    bits |= 1 << outside.setdefault(above[i], len(outside))
                else:
                    more, position = reach[int(inside[i])]
                    bits |= more
                    least = min(least, position)
            reach[here] = bits, least
            todo.pop()
    names = list(outside)
    found = []
    for first in entered.tolist():
        bits, least = reach[first]
        if least < np.inf:
            found.append((ids[first], None, int(least)))
        while bits:
            lowest = bits & -bits
            found.append((ids[first], names[lowest.bit_length() - 1], None))
            bits ^= lowest
    return found


def closed_blocks(blocks: CommitBlocks, positions: DataFrame, entered: DataFrame) -> DataFrame:
    """(walk_id, branch, commit_id, next_id, pos): where each of ``entered`` (block, walk_id, branch,
    commit_id) leaves its block to, and the least position of its walk that it reaches inside."""

    def close(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        ids = pd.Index(rows["commit_id"])
        places = np.unique(ids.get_indexer(asked["commit_id"]))
        made = closed_block(ids, rows["parents"].tolist(), rows["pos"].to_numpy(), places[places >= 0])
        result = pd.DataFrame(made, columns=["commit_id", "next_id", "pos"])
        result["pos"] = result["pos"].astype("Int64")
        for name in ("walk_id", "branch"):
            result[name] = asked[name].iloc[0] if len(asked) else None
        return result

    # Fresh aliases: the same written table may stand on both sides of the co-grouping.
    groups = entered.select(*[F.col(c).alias(c) for c in GROUP]).distinct()
    rows = (
        blocks.rows.select("block", "branch", "commit_id", "parents")
        .join(groups, ["block", "branch"])
        .join(positions, NODE, "left")
        .select(*GROUP, "commit_id", "parents", F.col("pos").cast("double").alias("pos"))
    )
    walk_type = positions.schema["walk_id"].dataType.simpleString()
    made = f"commit_id string, next_id string, pos bigint, walk_id {walk_type}, branch string"
    return rows.groupBy(*GROUP).cogroup(entered.groupBy(*GROUP)).applyInPandas(close, made)


def border_commits(blocks: CommitBlocks, branches: DataFrame) -> DataFrame:
    """(block, branch, commit_id): the parents of commits of other blocks, on the branches given."""
    rows = blocks.rows.join(branches, "branch", "left_semi")
    # A first parent whose row in the block is known does not lie in another one.
    others = F.when(F.col("up").isNotNull(), F.slice("parents", 2, F.size("parents"))).otherwise(F.col("parents")) if "up" in rows.columns else F.col("parents")
    links = settle(rows.select(F.col("block").alias("below"), "branch", F.explode(others).alias("commit_id")).distinct(), "links")
    homes = rows.select("block", "branch", "commit_id")
    return homes.join(links, ["branch", "commit_id"]).filter(F.col("block") != F.col("below")).select(
        "block", "branch", "commit_id"
    ).distinct()


def closure(reached: DataFrame, steps: DataFrame) -> tuple[DataFrame, int]:
    """All that ``reached`` (range_id and a node) leads to by any number of ``steps`` (a node and its next_id),
    and the rounds it took. Both must be written tables. The graph must have no circle."""
    leap, rounds, known = steps, 0, reached.count()
    while not leap.isEmpty():
        rounds += 1
        further = reached.join(leap, NODE).select("range_id", "walk_id", "branch", F.col("next_id").alias("commit_id"))
        reached = settle(reached.unionByName(further).distinct(), "reached")
        before, known = known, reached.count()
        if known == before:
            break
        onward = leap.select("walk_id", "branch", F.col("commit_id").alias("next_id"), F.col("next_id").alias("_end"))
        leap = settle(
            leap.join(onward, ["walk_id", "branch", "next_id"])
            .select(*NODE, F.col("_end").alias("next_id"))
            .distinct(),
            "leap",
        )
    return reached, rounds


def reached_positions(blocks: CommitBlocks, chain: DataFrame, ranges: DataFrame) -> tuple[DataFrame, int]:
    """(range_id, pos) of chain positions that starts reach, the least one of each among them; and the rounds.

    First the blocks that hold starts are closed; nearly all starts meet the chain there. Only if some leave
    their block elsewhere are the others closed, and what they lead to is found by doubling.
    """
    positions = chain.select(*NODE, "pos")
    homes = blocks.rows.select("block", "branch", "commit_id")
    asked = ranges.select("range_id", "walk_id", "branch", F.col("start_id").alias("commit_id"))
    # Few are asked for, and the chain and the log are long: what is found there comes first.
    asked = settle(asked, "asked")
    at = positions.join(asked.select(*NODE).distinct(), NODE, "left_semi")
    lie = homes.join(asked.select("branch", "commit_id").distinct(), ["branch", "commit_id"], "left_semi")
    placed = settle(asked.join(at, NODE, "left").join(lie, ["branch", "commit_id"], "left"), "starts")
    hits = [placed.filter(F.col("pos").isNotNull()).select("range_id", "pos")]
    # A start outside the log has no parents to go on with.
    starts = placed.filter(F.col("pos").isNull() & F.col("block").isNotNull()).select("range_id", *GROUP, "commit_id")
    if not starts.isEmpty():
        first = settle(closed_blocks(blocks, positions, starts.select(*GROUP, "commit_id")), "closed")
        hits.append(starts.join(first.filter("pos is not null"), NODE).select("range_id", "pos"))
        left = first.filter(F.col("next_id").isNotNull()).select(*NODE, "next_id")
        onward = starts.join(left, NODE).select("range_id", "walk_id", "branch", F.col("next_id").alias("commit_id"))
        onward = settle(onward.distinct(), "onward")
        met = settle(onward.join(positions.join(onward.select(*NODE).distinct(), NODE, "left_semi"), NODE, "left"), "met")
        hits.append(met.filter(F.col("pos").isNotNull()).select("range_id", "pos"))
        open_ = settle(met.filter(F.col("pos").isNull()).drop("pos"), "open")
    if starts.isEmpty() or open_.isEmpty():
        return _all(hits), 0
    walks = open_.select("walk_id", "branch").distinct()
    entered = border_commits(blocks, walks.select("branch").distinct()).join(walks, "branch")
    borders = settle(closed_blocks(blocks, positions, settle(entered.select(*GROUP, "commit_id"), "borders")), "closed")
    reached, rounds = closure(open_, settle(borders.filter(F.col("next_id").isNotNull()).select(*NODE, "next_id"), "steps"))
    hits.append(reached.join(borders.filter("pos is not null").select(*NODE, "pos"), NODE).select("range_id", "pos"))
    return _all(hits), rounds


def _all(parts: list[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def range_cuts(blocks: CommitBlocks, chain: DataFrame, ranges: DataFrame) -> DataFrame:
    """(range_id, cut): the smallest chain position that ``start_id`` reaches through any parent.

    An ancestor of the start that lies on the chain takes all later chain commits with it, so the
    excluded part of the chain is everything from the cut on. ``ranges`` is (range_id, walk_id, branch,
    start_id); pass written tables.
    """
    positions, _ = reached_positions(blocks, chain, ranges)
    return positions.groupBy("range_id").agg(F.min("pos").alias("cut"))
