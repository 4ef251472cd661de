"""Commit history: first-parent walks, ranges, cuts by date, sampling, revision lookup.

A first-parent walk follows a chain as long as the history, so stepping (or recursive SQL) takes as
many rounds as there are commits. Here the log is split into blocks of bounded size, ordered by
time so that most parents lie in the block of their child. Every block is shortened on its own to
"commit -> first commit outside the block"; the chain of blocks that remains is walked by pointer
doubling, and the positions found are then spread back inside the blocks. That shuffles the log a
fixed number of times, whatever the depth. Any split into blocks gives the same result. What a range
excludes is found in ``reachability``.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchledger.functions import text
from benchledger.operators.reachability import range_cuts
from benchledger.session import settle

# Commits per block: what one task holds in memory at a time.
BLOCK_ROWS = 50_000


@dataclass(frozen=True)
class CommitBlocks:
    """A commit log with a ``block`` number on every row; (branch, commit_id) is its key."""

    rows: DataFrame
    count: int
    # How blocks lead to each other, once a walk has needed it.
    ways: dict = field(default_factory=dict, compare=False, repr=False)


def commit_blocks(commit_log: DataFrame, block_rows: int = BLOCK_ROWS, least_blocks: int = 1) -> CommitBlocks:
    """Split the log into blocks of about ``block_rows`` commits, in the order of branch, time and id.

    A commit that the log holds twice counts once. The log is shuffled once, and each block is shortened where it
    lies, before it is written. ``commit_log`` is read several times; pass a written table.
    """
    log = _once_each(commit_log.select("branch", "commit_id", "commit_time", "parents"))
    blocks = max(least_blocks, math.ceil(commit_log.count() / block_rows))
    order = ["branch", "commit_time", "commit_id"]
    dealt = log.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    rows = dealt.select(F.spark_partition_id().alias("block"), "*", F.get("parents", F.lit(0)).alias("_parent0"))
    schema = f"{_schema(rows.drop('_parent0'))}, {PLACES}"
    return CommitBlocks(settle(rows.mapInArrow(_placed_batches, schema), "commit_blocks"), blocks)


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in rows.schema)


def _once_each(log: DataFrame) -> DataFrame:
    """Of rows with the same key, the least. Only keys whose hashes repeat are shuffled with all columns."""
    keyed = log.withColumn("_hash", F.xxhash64("branch", "commit_id"))
    twice = settle(keyed.groupBy("_hash").agg(F.count("*").alias("_rows")).filter("_rows > 1").select("_hash"), "twice")
    if twice.isEmpty():
        return log
    own = keyed.join(twice, "_hash", "left_semi").groupBy("branch", "commit_id").agg(F.min(F.struct("commit_time", "parents")).alias("_own"))
    least = own.select("branch", "commit_id", "_own.commit_time", "_own.parents")
    return settle(keyed.join(twice, "_hash", "left_anti").drop("_hash").unionByName(least), "commit_log")


# Where a commit stands in its block: its row, that of its first parent, that of the last commit on following
# first parents inside the block and the steps to it, and the commit outside that this one goes on with.
PLACES = "row int, up int, last int, hops int, out_id string"


def _placed(rows: pa.Table) -> pa.Table:
    """One block, or a branch of it, ordered by branch, with ``PLACES``. Has ``_parent0``, which is dropped."""
    size = rows.num_rows
    branches = pc.dictionary_encode(rows["branch"].combine_chunks(), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    starts = [0, *(np.flatnonzero(np.diff(branches)) + 1).tolist()]
    # Only what is looked up is copied into one piece; the other columns stay as they came.
    commit_ids, parent0 = rows["commit_id"].combine_chunks(), rows["_parent0"].combine_chunks()
    up = np.full(size, -1, np.int64)
    for start, end in zip(starts, [*starts[1:], size], strict=True):
        ids = commit_ids.slice(start, end - start)
        inside = pc.index_in(parent0.slice(start, end - start), value_set=ids, skip_nulls=True)
        inside = pc.fill_null(inside, -1).to_numpy(zero_copy_only=False)
        up[start:end] = np.where(inside >= 0, inside + start, -1)
    last, hops = followed(up)
    made = {
        "row": pa.array(np.arange(size), pa.int32()),
        "up": pa.array(up, pa.int32(), mask=up < 0),
        "last": pa.array(last, pa.int32()),
        "hops": pa.array(hops, pa.int32()),
        "out_id": parent0.take(pa.array(last)),
    }
    rows = rows.drop_columns(["_parent0"])
    for name, values in made.items():
        rows = rows.append_column(name, values)
    return rows


def followed(link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last row on following ``link`` (-1: none) from each row, and the steps to it."""
    last = np.where(link >= 0, link, np.arange(len(link)))
    hops = (link >= 0).astype(np.int64)
    for _ in range(len(link).bit_length() + 1):
        hops = hops + hops[last]
        last = last[last]
    return last, hops


def _placed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [batch for batch in batches if batch.num_rows]
    if held:
        yield from _placed(pa.Table.from_batches(held)).to_batches(max_chunksize=20_000)


def _with_places(blocks: CommitBlocks) -> DataFrame:
    """The rows of the blocks with ``PLACES``, which blocks have that ``commit_blocks`` made."""
    if "out_id" in blocks.rows.columns:
        return blocks.rows
    if "places" not in blocks.ways:
        rows = blocks.rows.withColumn("_parent0", F.get("parents", F.lit(0)))
        placed = rows.groupBy("block", "branch").applyInArrow(_placed, f"{_schema(blocks.rows)}, {PLACES}")
        blocks.ways["places"] = settle(placed, "places")
    return blocks.ways["places"]


def resolve_revisions(wanted: DataFrame, commit_log: DataFrame, refs: DataFrame) -> DataFrame:
    """Add ``resolved_id`` and ``resolution`` to rows of (branch, revision).

    ``HEAD`` is the branch head; anything else is a commit id or a unique beginning of one, of any
    length. Resolution is ``resolved``, ``ambiguous`` or ``unknown``.
    """
    revisions = wanted.select("branch", "revision").distinct()
    heads = revisions.filter(F.col("revision") == "HEAD").join(
        refs.select("branch", F.col("head").alias("_first"), F.col("head").alias("_last")), "branch", "left"
    )
    named = revisions.filter(F.col("revision") != "HEAD").withColumn(
        "_short", F.substring("revision", 1, text.SHORT_ID_LENGTH)
    )
    ids = commit_log.select("branch", "commit_id")
    # From seven characters on, few commits share the beginning, and the rest of it is compared.
    commits = ids.withColumn("_short", text.short_id(F.col("commit_id")))
    long = (
        named.filter(F.length("revision") >= text.SHORT_ID_LENGTH)
        .join(commits, ["branch", "_short"], "left")
        .withColumn("commit_id", F.when(F.col("commit_id").startswith(F.col("revision")), F.col("commit_id")))
        .groupBy("branch", "revision")
        .agg(F.min("commit_id").alias("_first"), F.max("commit_id").alias("_last"))
    )
    # Of shorter ones there are at most as many as hexadecimal numbers of the length, so commits are
    # combined by beginning before they meet them.
    brief = named.filter(F.length("revision") < text.SHORT_ID_LENGTH)
    lengths = sorted(row[0] for row in brief.select(F.length("revision")).distinct().collect())
    found = heads.select("branch", "revision", "_first", "_last").unionByName(long)
    if lengths:
        starts = F.explode(F.array(*[F.substring("commit_id", 1, length) for length in lengths]))
        sums = ids.select("branch", starts.alias("revision"), "commit_id").groupBy("branch", "revision").agg(
            F.min("commit_id").alias("_first"), F.max("commit_id").alias("_last")
        )
        found = found.unionByName(brief.drop("_short").join(sums, ["branch", "revision"], "left"))
    answers = found.select(
        "branch",
        "revision",
        F.when(F.col("_first") == F.col("_last"), F.col("_first")).alias("resolved_id"),
        F.when(F.col("_first").isNull(), "unknown")
        .when(F.col("_first") == F.col("_last"), "resolved")
        .otherwise("ambiguous")
        .alias("resolution"),
    )
    return wanted.join(answers, ["branch", "revision"], "left")


def _ways(blocks: CommitBlocks) -> tuple[DataFrame, list[DataFrame]]:
    """Every commit's jump out of its block, and jumps of 1, 2, 4, ... blocks from where such jumps end.

    The same for all walks, so that a second walk of the log finds them there.
    """
    if "jumps" not in blocks.ways:
        hops = (F.col("hops") + 1).cast("bigint").alias("hops")
        jumps = _with_places(blocks).filter("out_id is not null").select("branch", "commit_id", F.col("out_id").alias("next_id"), hops)
        targets = settle(jumps.select("branch", F.col("next_id").alias("commit_id")).distinct(), "targets")
        leap = settle(jumps.join(targets, ["branch", "commit_id"], "left_semi"), "leap")
        leaps = []
        while not leap.isEmpty():
            leaps.append(leap)
            onward = leap.select(
                "branch", F.col("commit_id").alias("next_id"), F.col("next_id").alias("_end"), F.col("hops").alias("_more")
            )
            leap = settle(
                leap.join(onward, ["branch", "next_id"]).select(
                    "branch", "commit_id", F.col("_end").alias("next_id"), (F.col("hops") + F.col("_more")).alias("hops")
                ),
                "leap",
            )
        blocks.ways.update(jumps=jumps, leaps=leaps)
    return blocks.ways["jumps"], blocks.ways["leaps"]


def _block_entries(blocks: CommitBlocks, walks: DataFrame) -> DataFrame:
    """Where each walk enters a block: (walk_id, branch, commit_id, pos), by pointer doubling."""
    reached = walks.select("walk_id", "branch", "commit_id", F.lit(0).cast("bigint").alias("pos"))
    if blocks.count == 1:
        return reached
    jumps, leaps = _ways(blocks)

    def further(from_: DataFrame, by: DataFrame) -> DataFrame:
        return from_.join(by, ["branch", "commit_id"]).select(
            "walk_id", "branch", F.col("next_id").alias("commit_id"), (F.col("pos") + F.col("hops")).alias("pos")
        )

    entered = settle(further(reached, jumps), "reached")
    for leap in leaps:
        entered = settle(entered.unionByName(further(entered, leap)), "reached")
    return reached.unionByName(entered)


def block_entries(blocks: CommitBlocks, walks: DataFrame) -> DataFrame:
    """(block, branch, row, walk_id, pos): the rows where each walk enters a block. Written."""
    reached = _block_entries(blocks, walks)
    at = _with_places(blocks).select("block", "branch", "commit_id", "row")
    return settle(at.join(reached, ["branch", "commit_id"]).select("block", "branch", "row", "walk_id", "pos"), "entries")


def first_parent_log(blocks: CommitBlocks, walks: DataFrame) -> DataFrame:
    """Commits met by following first parents from each walk's start.

    ``walks`` is (walk_id, branch, commit_id). The result is (walk_id, branch, commit_id,
    commit_time, pos) with pos 0 at the start: newest first. A walk ends at the root, or where the
    parent is not in the log.
    """
    entries = block_entries(blocks, walks)
    log = _with_places(blocks).select("block", "branch", "commit_id", "commit_time", "row", "up")

    def spread(_: tuple, rows: pa.Table, entered: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        # The rows of a branch follow each other in a block.
        first = rows["row"][0].as_py()
        up = pc.fill_null(rows["up"], -1).to_numpy()
        jump = np.where(up >= 0, up - first, -1)
        at, pos = entered["row"].to_numpy() - first, entered["pos"].to_numpy()
        walk = np.arange(len(at))
        length = 1
        # The commits up to a distance, then those as far again from each of them.
        while (jump >= 0).any():
            further = jump[at]
            inside = further >= 0
            at, walk = np.concatenate([at, further[inside]]), np.concatenate([walk, walk[inside]])
            pos = np.concatenate([pos, pos[inside] + length])
            jump = np.where(jump >= 0, jump[jump], -1)
            length *= 2
        met = rows.select(["branch", "commit_id", "commit_time"]).take(pa.array(at))
        named = entered["walk_id"].take(pa.array(walk))
        return met.add_column(0, "walk_id", named).append_column("pos", pa.array(pos, pa.int64()))

    walk_type = walks.schema["walk_id"].dataType.simpleString()
    time_type = log.schema["commit_time"].dataType.simpleString()
    entered_blocks = settle(entries.select("block", "branch").distinct(), "entered_blocks")
    return (
        log.join(entered_blocks, ["block", "branch"], "left_semi")
        .groupBy("block", "branch")
        .cogroup(entries.groupBy("block", "branch"))
        .applyInArrow(
            spread,
            f"walk_id {walk_type}, branch string, commit_id string, commit_time {time_type}, pos bigint",
        )
    )


def shared_chains(
    blocks: CommitBlocks, ranges: DataFrame, refs: DataFrame, walk: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(chain, ranges with ``chain_id`` and ``end_pos``): each branch's history once, and ranges as parts of it.

    ``ranges`` has ``walk_id``, the commit that a range ends at, and ``branch``. An end on its branch's
    first-parent history from the head is a position there; only other ends are walked on their own.
    ``walk`` follows walks in place of ``first_parent_log``. Both tables are written.
    """
    if walk is None:
        walk = partial(first_parent_log, blocks)
    ends = settle(ranges.select("branch", "walk_id").distinct(), "ends")
    heads = refs.join(ends.select("branch").distinct(), "branch", "left_semi").select(
        F.col("head").alias("walk_id"), "branch", F.col("head").alias("commit_id")
    )
    trunk = settle(walk(heads), "trunk")
    on_trunk = trunk.select("branch", F.col("commit_id").alias("walk_id"), F.col("walk_id").alias("chain_id"), F.col("pos").alias("end_pos"))
    on_trunk = on_trunk.join(ends, ["branch", "walk_id"], "left_semi")
    placed = settle(ends.join(on_trunk, ["branch", "walk_id"], "left"), "placed_ends")
    apart = placed.filter(F.col("chain_id").isNull()).select("walk_id", "branch", F.col("walk_id").alias("commit_id"))
    chain = trunk if apart.isEmpty() else settle(trunk.unionByName(walk(apart)), "chain")
    shared = placed.select(
        "branch",
        "walk_id",
        F.coalesce("chain_id", "walk_id").alias("chain_id"),
        F.coalesce("end_pos", F.lit(0)).alias("end_pos"),
    )
    return chain, settle(ranges.join(shared, ["branch", "walk_id"]), "ranges")


def first_parent_range(blocks: CommitBlocks, chain: DataFrame, ranges: DataFrame) -> DataFrame:
    """The first-parent commits of each range from its end, without its start and all reachable from that.

    ``ranges`` is (range_id, chain_id, end_pos, branch, start_id), as from ``shared_chains``. The result
    is (range_id, branch, commit_id, commit_time, pos) with pos 0 at the end of the range. ``chain`` and
    ``ranges`` are read several times; pass written tables.
    """
    asked = ranges.select("range_id", F.col("chain_id").alias("walk_id"), "branch", "start_id")
    cuts = ranges.select("range_id", F.col("chain_id").alias("walk_id"), "branch", "end_pos").join(
        range_cuts(blocks, chain, asked), "range_id", "left"
    )
    cuts = settle(cuts, "cuts")
    return (
        chain.join(cuts, ["walk_id", "branch"])
        .filter((F.col("pos") >= F.col("end_pos")) & (F.col("cut").isNull() | (F.col("pos") < F.col("cut"))))
        .select("range_id", "branch", "commit_id", "commit_time", (F.col("pos") - F.col("end_pos")).alias("pos"))
    )


def before(commit_time: Column, start: dt.datetime) -> Column:
    """By whole seconds."""
    limit = F.lit(int(start.replace(tzinfo=dt.timezone.utc).timestamp()))
    return F.unix_seconds(commit_time.cast("timestamp")) < limit


def log_to_date(chain: DataFrame, start: dt.datetime) -> DataFrame:
    """Walk back to the first commit before ``start`` and keep that one too.

    Later commits of the walk are left out even when their own time is newer. Times compare in
    whole seconds. The cut is one aggregated number per walk, so no walk has to fit one task.
    ``chain`` is read twice; pass a written table.
    """
    too_old = before(F.col("commit_time"), start)
    # Written, so that its size is known: the chain is not shuffled for one number per walk.
    cuts = settle(chain.groupBy("walk_id", "branch").agg(F.min(F.when(too_old, F.col("pos"))).alias("_cut")), "cuts")
    return (
        chain.join(cuts, ["walk_id", "branch"])
        .filter(F.col("_cut").isNull() | (F.col("pos") <= F.col("_cut")))
        .drop("_cut")
    )


def sampled(commit_id: Column, rate: Column) -> Column:
    """Stable sampling by the id itself: raising the rate keeps every commit picked before."""
    return text.sample_prefix(commit_id) <= text.sample_ceiling_column(rate)


def sample_log(log: DataFrame, rates: DataFrame, key: str) -> DataFrame:
    """Sampled commits of each log plus its oldest one.

    ``rates`` is (key, sampling), one row per log. The oldest position is an aggregated number.
    """
    oldest = log.groupBy(key).agg(F.max("pos").alias("_oldest"))
    limits = settle(rates.select(key, "sampling").join(oldest, key), "limits")
    return (
        log.join(limits, key)
        .filter(sampled(F.col("commit_id"), F.col("sampling")) | (F.col("pos") == F.col("_oldest")))
        .drop("_oldest", "sampling")
    )


def missing_branches(configured: DataFrame, ref_names: DataFrame) -> DataFrame:
    """Configured branches without a local one; each known branch takes away one copy."""
    known = ref_names.select(text.last_segment(F.col("ref_name")).alias("branch"))
    return configured.select("branch").exceptAll(known)
