"""A stored index of first-parent history that new commits extend.

Walking all history for every plan costs as much as the history is long. The index keeps, for every commit,
where it stands: its trunk and its depth there (first parents down to the root). A trunk is a run of first
parents that no other run shares; of the children of a commit, the one on the way to a branch head goes on with
its trunk, else the latest one, and any other begins a trunk of its own, which remembers where it left. The
history of a commit is then its trunk up to its depth, what that trunk left, and so on: a join, no walk.

A batch holds the commits that are new since the last one, with their parents in it or in an earlier batch.
Only it is walked. The places of the older parents are looked up newest batch first, in windows that double,
so that a daily batch reads what lies a day or two back, and old batches only when a branch leaves there.
Batches are folders; a repeated batch replaces itself, and later ones must then be repeated, too.

Along any history batches never get newer, so a reader that needs its newest part reads the newest batches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchledger.operators import commits
from benchledger.session import settle

COMMITS = (
    "branch string, commit_id string, commit_time timestamp_ntz, parents array<string>, "
    "trunk string, depth bigint, block bigint, batch int"
)
TRUNKS = "branch string, trunk string, base_depth bigint, parent_trunk string, parent_depth bigint, batch int"
NODE = ["branch", "commit_id"]
NODE_ROW = ["block", "row"]


@dataclass(frozen=True)
class ChainIndex:
    """A folder with the batches ``commits/batch=n`` and ``trunks/batch=n``."""

    spark: SparkSession
    path: str

    def batches(self) -> list[int]:
        """The numbers of the stored batches, ascending. A batch counts once both of its tables are whole."""
        there = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/trunks")
        files = there.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(there):
            return []
        done = [f.getPath() for f in files.listStatus(there) if f.isDirectory()]
        whole = [p.getName() for p in done if files.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(name.split("=")[1]) for name in whole)

    def _table(self, name: str, schema: str, batches: list[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/{name}/batch={batch}" for batch in batches]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*folders)

    def commits(self, batches: list[int] | None = None) -> DataFrame:
        return self._table("commits", COMMITS, self.batches() if batches is None else batches)

    def trunks(self, batches: list[int] | None = None) -> DataFrame:
        return self._table("trunks", TRUNKS, self.batches() if batches is None else batches)

    def blocks(self) -> commits.CommitBlocks:
        """The log in the blocks that its batches were cut into, with no need to cut it again."""
        rows = self.commits().select("block", *NODE, "commit_time", "parents")
        return commits.CommitBlocks(rows, rows.select("block").distinct().count())

    def walk(self, walks: DataFrame) -> DataFrame:
        """Walks out of the index instead of the log."""
        return stored_log(self, walks)

    def windows(self, batches: list[int]) -> list[list[int]]:
        """The newest batch, the two before it, the four before those, ..."""
        found, size, left = [], 1, list(batches)
        while left:
            found.append(left[-size:])
            left = left[:-size]
            size *= 2
        return found


def _closed(steps: DataFrame) -> DataFrame:
    """Each of ``steps`` (a NODE_ROW, the ``to_block`` and ``to_row`` it goes on to, ``add``) prolonged to its end."""
    while True:
        ahead = steps.select(
            F.col("block").alias("to_block"), F.col("row").alias("to_row"),
            F.col("to_block").alias("_block"), F.col("to_row").alias("_row"), F.col("add").alias("_add"),
        )
        further = settle(
            steps.join(ahead, ["to_block", "to_row"], "left").select(
                *NODE_ROW,
                F.coalesce("_block", "to_block").alias("to_block"),
                F.coalesce("_row", "to_row").alias("to_row"),
                (F.col("add") + F.coalesce("_add", F.lit(0))).alias("add"),
                F.col("_row").isNotNull().alias("moved"),
            ),
            "steps",
        )
        steps = further.drop("moved")
        if further.filter("moved").isEmpty():
            return steps


# What is known of rows of a block beforehand: where the ways from the heads enter it, parents of commits of other
# blocks, what the depths behind a row that leaves the block add up to, the trunk of a row whose trunk is not begun
# by itself, and the trunk of a parent outside the block.
ENTERED, PARENT, DEPTH, TRUNK, ABOVE = range(5)
MARKS = "block int, row int, mark int, number bigint, trunk string"


def _marks(rows: DataFrame, mark: int, number: str = "NULL", trunk: str = "NULL") -> DataFrame:
    return rows.selectExpr("block", "row", f"{mark} AS mark", f"CAST({number} AS bigint) AS number", f"CAST({trunk} AS string) AS trunk")


def _by_row(rows: pa.Table, marks: pa.Table) -> tuple[pa.Table, np.ndarray, dict[int, pa.Table], np.ndarray, np.ndarray]:
    """A block in order: its rows, ``up``, its marks by kind, which rows are on the ways from the heads, and the link
    from each to its parent if it goes on with the trunk of that and nothing outside may do so instead (-1: none)."""
    rows = rows.combine_chunks().sort_by("row")
    up = pc.fill_null(rows["up"], -1).to_numpy().astype(np.int64)
    size = len(up)
    of = {mark: marks.filter(pc.equal(marks["mark"], mark)) for mark in (ENTERED, PARENT, DEPTH, TRUNK, ABOVE)}
    main = np.zeros(size, bool)
    main[of[ENTERED]["row"].to_numpy()] = True
    jump = up
    while (jump >= 0).any():
        main[jump[main & (jump >= 0)]] = True
        jump = np.where(jump >= 0, jump[jump], -1)
    # Rows are in the order of time and id.
    inside = np.flatnonzero(up >= 0)
    best = np.full(size, -1, np.int64)
    np.maximum.at(best, up[inside], main[inside] * size + inside)
    heir = np.where(best >= 0, best % size, -1)
    open_ = np.zeros(size, bool)
    open_[of[PARENT]["row"].to_numpy()] = True
    goes_on = (up >= 0) & (heir[up] == np.arange(size)) & ~open_[up]
    of[-1] = pa.table({"heir": heir})
    return rows, up, of, main, np.where(goes_on, up, -1)


def _border(rows: pa.Table, marks: pa.Table) -> pa.Table:
    """(block, row, kind, main, at): rows that leave the block; and of each parent of commits of other blocks the child
    that goes on with it, ``at`` is the parent, and the row ``at`` that the trunk there comes from."""
    if not rows.num_rows:
        return pa.table({n: pa.array([], t) for n, t in BORDER_TYPES.items()})
    rows, up, of, main, link = _by_row(rows, marks)
    base, _ = commits.followed(link)
    heir = of[-1]["heir"].to_numpy()
    parents = np.unique(of[PARENT]["row"].to_numpy()).astype(np.int64)
    children, leaving = parents[heir[parents] >= 0], np.flatnonzero((up < 0) & rows["leaves"].to_numpy(zero_copy_only=False))
    parts = [("leaving", leaving, leaving), ("child", heir[children], children), ("parent", parents, base[parents])]
    row, at = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    kinds = [kind for kind, found, _ in parts for _ in found]
    values = [np.full(len(row), rows["block"][0].as_py()), row, kinds, main[row], at]
    return pa.table({n: pa.array(v, t) for (n, t), v in zip(BORDER_TYPES.items(), values, strict=True)})


BORDER = "block int, row int, kind string, main boolean, at int"
BORDER_TYPES = {"block": pa.int32(), "row": pa.int32(), "kind": pa.string(), "main": pa.bool_(), "at": pa.int32()}
STORED = (
    "branch string, commit_id string, commit_time timestamp_ntz, parents array<string>, trunk string, depth bigint, "
    "block int, parent_trunk string, parent_depth bigint"
)


def _stored(rows: pa.Table, marks: pa.Table) -> pa.Table:
    """The commits of a block with trunk and depth; those that begin a trunk with what that left."""
    if not rows.num_rows:
        return rows.drop_columns(["row", "up", "last", "hops", "leaves"]).append_column("trunk", pa.array([], pa.string())).append_column(
            "depth", pa.array([], pa.int64())
        ).append_column("parent_trunk", pa.array([], pa.string())).append_column("parent_depth", pa.array([], pa.int64())).select(STORED_NAMES)
    rows, up, of, _, link = _by_row(rows, marks)
    size = len(up)
    behind = np.zeros(size, np.int64)
    behind[of[DEPTH]["row"].to_numpy()] = of[DEPTH]["number"].to_numpy()
    depth = rows["hops"].to_numpy() + behind[rows["last"].to_numpy()]
    # Trunks by number: a commit of the block, or one of the names that are known.
    base, _ = commits.followed(link)
    names = pa.chunked_array([*rows["commit_id"].chunks, *of[TRUNK]["trunk"].chunks, *of[ABOVE]["trunk"].chunks], pa.string()).combine_chunks()
    known, above = of[TRUNK]["row"].to_numpy(), of[ABOVE]["row"].to_numpy()
    number = np.arange(size)
    number[known] = size + np.arange(len(known))
    trunk = number[base]
    left = np.where(up >= 0, trunk[up], -1)
    left[above] = size + len(known) + np.arange(len(above))
    # A commit that begins a trunk, as no other has its name.
    names_ = names.take(pa.array(trunk))
    begins = pc.equal(names_, rows["commit_id"].combine_chunks()).to_numpy(zero_copy_only=False).astype(bool) & (left >= 0)
    more = {
        "trunk": names_,
        "depth": pa.array(depth, pa.int64()),
        "parent_trunk": names.take(pa.array(left, mask=~begins)),
        "parent_depth": pa.array(depth - 1, pa.int64(), mask=~begins),
    }
    for name, values in more.items():
        rows = rows.append_column(name, values)
    return rows.select(STORED_NAMES)


STORED_NAMES = ["branch", "commit_id", "commit_time", "parents", "trunk", "depth", "block", "parent_trunk", "parent_depth"]


def places(index: ChainIndex, wanted: DataFrame, batches: list[int]) -> DataFrame:
    """(branch, commit_id, trunk, depth, goes_on) of the wanted commits (branch, commit_id) that are stored.

    ``goes_on`` says that the trunk has a commit after it. Reads the newest batches first and stops when all
    are found; what leaves no trace in any batch is not in the result. Written.
    """
    wanted = settle(wanted.distinct(), "wanted")
    found = None
    read: list[int] = []
    for window in index.windows(batches):
        if wanted.isEmpty():
            break
        read = window + read
        here = settle(index.commits(window).select(*NODE, "trunk", "depth").join(wanted, NODE, "left_semi"), "here")
        place = ["branch", "trunk", "depth"]
        next_ = index.commits(read).select("branch", "trunk", (F.col("depth") - 1).alias("depth"))
        next_ = next_.join(here.select(*place).distinct(), place, "left_semi").withColumn("goes_on", F.lit(True))
        here = settle(
            here.join(next_, place, "left").select(*NODE, "trunk", "depth", F.coalesce("goes_on", F.lit(False)).alias("goes_on")),
            "found",
        )
        found = here if found is None else found.unionByName(here)
        wanted = settle(wanted.join(here, NODE, "left_anti"), "wanted")
    if found is None:
        return index.spark.createDataFrame([], "branch string, commit_id string, trunk string, depth bigint, goes_on boolean")
    return found


def append(index: ChainIndex, new: DataFrame, refs: DataFrame, batch: int, least_blocks: int = 1) -> None:
    """Store the new commits (branch, commit_id, commit_time, parents) as a batch; ``refs`` has the heads.

    Commits of earlier batches must not be among them. A parent that is nowhere ends the history, as a root does.
    """
    older = [number for number in index.batches() if number < batch]
    new = new.select(*NODE, "commit_time", "parents").filter("branch IS NOT NULL AND commit_id IS NOT NULL")
    blocks = commits.commit_blocks(new, least_blocks=least_blocks)
    rows = blocks.rows.withColumn("leaves", F.expr("up IS NULL AND out_id IS NOT NULL"))
    walks = refs.select(F.col("head").alias("walk_id"), "branch", F.col("head").alias("commit_id"))
    entered = _marks(commits.block_entries(blocks, walks).select(*NODE_ROW).distinct(), ENTERED)

    # Where the commits go on whose parent is not in their block: in another one, in an earlier batch, or nowhere.
    leaving = settle(rows.filter("leaves").select(*NODE_ROW, "branch", F.col("out_id").alias("commit_id")), "leaving")
    asked = settle(leaving.select(*NODE).distinct(), "asked")
    homes = settle(
        rows.select(
            *NODE, F.col("block").alias("to_block"), F.col("row").alias("to_row"), F.col("last").alias("to_last"), F.col("hops").alias("to_hops")
        ).join(asked, NODE, "left_semi"),
        "homes",
    )
    known = places(index, asked.join(homes, NODE, "left_anti"), older)
    inside = settle(leaving.join(homes, NODE), "inside")
    stored = settle(leaving.join(known, NODE), "stored")

    # Of the children of a commit, one goes on with its trunk.
    parents = _marks(homes.select(F.col("to_block").alias("block"), F.col("to_row").alias("row")), PARENT)
    border = settle(_by_block(rows.select(*NODE_ROW, "up", "leaves"), entered.unionByName(parents), _border, BORDER), "border")
    own = border.filter("kind = 'child'").select(F.col("block").alias("to_block"), F.col("at").alias("to_row"), *NODE_ROW, "main")
    own = own.join(homes, ["to_block", "to_row"]).select(*NODE, *NODE_ROW, "main")
    foreign = leaving.join(border.filter("kind = 'leaving'").select(*NODE_ROW, "main"), NODE_ROW).select(*NODE, *NODE_ROW, "main")
    heirs = own.unionByName(foreign).groupBy(*NODE).agg(F.max(F.struct("main", *NODE_ROW)).alias("_heir"))
    heirs = settle(heirs.select(*NODE, "_heir.block", "_heir.row"), "heirs")
    # The trunk of a stored commit may have gone on already.
    goes_on = heirs.join(known.filter("NOT goes_on"), NODE).select(*NODE_ROW, "trunk")
    bases = border.filter("kind = 'parent'").select(F.col("block").alias("to_block"), F.col("row").alias("to_row"), "at")
    bases = settle(homes.join(bases, ["to_block", "to_row"]).select(*NODE, "to_block", "to_row", "at"), "bases")
    steps = heirs.join(bases, NODE).select(*NODE_ROW, "to_block", F.col("at").alias("to_row"), F.lit(0).cast("bigint").alias("add"))
    steps = _closed(settle(steps, "steps"))
    # The trunk that each of these rows is on: a stored one, or one that the row begins where the steps end.
    on = bases.select(F.col("to_block").alias("block"), F.col("at").alias("row")).unionByName(steps.select(*NODE_ROW)).distinct()
    on = settle(on.join(steps, NODE_ROW, "left").select(*NODE_ROW, *[F.coalesce(f"to_{c}", c).alias(f"to_{c}") for c in NODE_ROW]), "on")
    ends = on.select(F.col("to_block").alias("block"), F.col("to_row").alias("row")).unionByName(goes_on.select(*NODE_ROW)).distinct()
    ends = rows.select(*NODE_ROW, "commit_id").join(settle(ends, "ends"), NODE_ROW)
    ends = settle(ends.join(goes_on, NODE_ROW, "left").select(*NODE_ROW, F.coalesce("trunk", "commit_id").alias("trunk")), "ends")
    named = ends.select(F.col("block").alias("to_block"), F.col("row").alias("to_row"), "trunk")
    trunks = settle(on.join(named, ["to_block", "to_row"]).select(*NODE_ROW, "trunk").unionByName(ends).distinct(), "trunks")
    of_parents = bases.join(trunks.select(F.col("block").alias("to_block"), F.col("row").alias("at"), "trunk"), ["to_block", "at"])
    above = inside.select(*NODE_ROW, *NODE).join(of_parents.select(*NODE, "trunk"), NODE).unionByName(stored.select(*NODE_ROW, *NODE, "trunk"))

    # Depths: the hops of a block, and those behind the commit where it is left.
    hops = (F.col("to_hops") + 1).cast("bigint").alias("add")
    down = _closed(settle(inside.select(*NODE_ROW, "to_block", F.col("to_last").alias("to_row"), hops), "steps"))
    below = stored.select(*NODE_ROW, (F.col("depth") + 1).alias("depth"))
    deep = below.select(F.col("block").alias("to_block"), F.col("row").alias("to_row"), "depth")
    depths = down.join(deep, ["to_block", "to_row"], "left").select(*NODE_ROW, (F.col("add") + F.coalesce("depth", F.lit(0))).alias("depth"))
    marks = [entered, parents, _marks(depths.unionByName(below), DEPTH, "depth"), _marks(trunks, TRUNK, trunk="trunk"), _marks(above, ABOVE, trunk="trunk")]
    marks = settle(reduce(DataFrame.unionByName, marks), "marks")

    # A trunk begins at its own base; what it left is the trunk and depth of its base's parent.
    stored_rows = _by_block(rows.drop("out_id"), marks, _stored, STORED)
    path = f"{index.path}/commits/batch={batch}"
    # No other batch has these block numbers.
    block = (F.lit(batch).cast("bigint") * 2**32 + F.col("block")).alias("block")
    stored_rows.withColumn("block", block).write.mode("overwrite").parquet(path, compression="zstd")
    begun = index.spark.read.schema(f"{COMMITS}, parent_trunk string, parent_depth bigint").parquet(path).filter("trunk = commit_id")
    begun.select("branch", "trunk", F.col("depth").alias("base_depth"), "parent_trunk", "parent_depth").write.mode("overwrite").parquet(
        f"{index.path}/trunks/batch={batch}", compression="zstd"
    )


def _by_block(rows: DataFrame, marks: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work`` on each block and its marks."""
    return rows.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(work, schema)


def _segments(index: ChainIndex, walks: DataFrame) -> DataFrame:
    """(walk_id, branch, trunk, top, pos): the trunks of each walk, from which depth down, and the position there.

    ``walks`` is (walk_id, branch, commit_id). Trunks are followed by doubling.
    """
    at = places(index, walks.select(*NODE), index.batches()).select(*NODE, "trunk", "depth")
    reached = settle(
        walks.join(at, NODE).select("walk_id", "branch", "trunk", F.col("depth").alias("top"), F.lit(0).cast("bigint").alias("pos")), "reached"
    )
    # From a trunk (entered anywhere) to another one, entered at ``top``: the depth there counts down from ``base``.
    leap = index.trunks().filter("parent_trunk is not null").select("branch", "trunk", F.col("parent_trunk").alias("to"), F.col("parent_depth").alias("to_top"))
    while not leap.isEmpty():
        further = reached.join(leap, ["branch", "trunk"]).select(
            "walk_id", "branch", F.col("to").alias("trunk"), F.col("to_top").alias("top"), (F.col("pos") + F.col("top") - F.col("to_top")).alias("pos")
        )
        more = settle(further, "reached")
        if more.isEmpty():
            break
        reached = settle(reached.unionByName(more), "reached")
        # Most trunks are side commits, which nothing leaves.
        left = settle(leap.select("branch", F.col("to").alias("trunk")).distinct(), "left")
        onward = settle(leap.join(left, ["branch", "trunk"], "left_semi"), "onward")
        onward = onward.select("branch", F.col("trunk").alias("to"), F.col("to").alias("_to"), F.col("to_top").alias("_top"))
        leap = settle(
            leap.join(onward, ["branch", "to"]).select("branch", "trunk", F.col("_to").alias("to"), F.col("_top").alias("to_top")), "leap"
        )
    return reached


def stored_log(index: ChainIndex, walks: DataFrame, start: dt.datetime | None = None) -> DataFrame:
    """(walk_id, branch, commit_id, commit_time, pos): what ``commits.first_parent_log`` gives, from the index.

    With ``start``, each walk ends at its first commit before that time, as by ``commits.log_to_date``; then only
    as many of the newest batches are read as hold these. A walk from a commit that is not stored is empty.
    """
    segments = settle(_segments(index, walks), "segments")

    def chain(batches: list[int]) -> DataFrame:
        return index.commits(batches).join(segments, ["branch", "trunk"]).filter("depth <= top").select(
            "walk_id", *NODE, "commit_time", (F.col("pos") + F.col("top") - F.col("depth")).alias("pos")
        )

    if start is None:
        return chain(index.batches())
    begun = segments.select("walk_id", "branch").distinct()
    parts: list[DataFrame] = []
    for window in index.windows(index.batches()):
        parts.append(settle(chain(window), "chain"))
        old = parts[-1].filter(commits.before(F.col("commit_time"), start)).select("walk_id", "branch")
        begun = settle(begun.join(old, ["walk_id", "branch"], "left_anti"), "open_walks")
        if begun.isEmpty():
            break
    rows = parts[0] if parts else chain([])
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return commits.log_to_date(rows, start)
