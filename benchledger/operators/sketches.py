"""Small summaries that are stored per batch and merged over any window, without the rows behind them.

Latencies: one KLL sketch per run and day, with exact counts and extremes beside it. Task coverage: theta
sketches of the sets of completed and needed tasks, of which union, intersection and difference are sketches
again. All sketches have a bounded size, so neither a hot run nor a long window makes one large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a latency sketch. The error of a rank is at most RANK_ERROR of all samples, with 99 % confidence
#: for one query; up to this many samples it is none.
KLL_SIZE = 800
RANK_ERROR = 0.0045
#: A set of up to 2 ** LG_ENTRIES tasks is exact; beyond, the relative standard error of a count is SET_ERROR.
LG_ENTRIES = 14
SET_ERROR = 2 ** -(LG_ENTRIES / 2)

DAILY = "run_key bigint, day date, requests bigint, latency_sum_us bigint, min_us bigint, max_us bigint, sketch binary"
COVERAGE = "task_set string, tasks binary, commits binary"


def daily_sketches(samples: DataFrame) -> DataFrame:
    """One row per run and day."""
    return samples.groupBy("run_key", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("requests"),
        F.sum("latency_us").alias("latency_sum_us"),
        F.min("latency_us").alias("min_us"),
        F.max("latency_us").alias("max_us"),
        F.kll_sketch_agg_bigint("latency_us", F.lit(KLL_SIZE)).alias("sketch"),
    )


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a key as one row of the same kind."""
    return sketches.groupBy(*keys).agg(
        F.sum("requests").alias("requests"),
        F.sum("latency_sum_us").alias("latency_sum_us"),
        F.min("min_us").alias("min_us"),
        F.max("max_us").alias("max_us"),
        F.kll_merge_agg_bigint("sketch", F.lit(KLL_SIZE)).alias("sketch"),
    )


def sliding(sketches: DataFrame, days: int, every: int) -> DataFrame:
    """Each row once for every window that its day lies in: windows of ``days`` that begin ``every`` days."""
    day = F.unix_date("day")
    last = day - F.pmod(day, F.lit(every))
    first = F.floor((day - days) / every) * every + every
    starts = F.sequence(first.cast("int"), last.cast("int"), F.lit(every))
    return sketches.withColumn("window_start", F.explode(F.transform(starts, F.date_from_unix_date)))


def percentiles(sketches: DataFrame, levels: Sequence[int]) -> DataFrame:
    """``percentile`` and ``latency_us`` for each row and level, by nearest rank."""
    each = F.array(
        *[
            F.struct(
                F.lit(level).alias("percentile"),
                F.kll_sketch_get_quantile_bigint("sketch", F.lit(level / 100)).alias("latency_us"),
            )
            for level in levels
        ]
    )
    return sketches.withColumn("_level", F.explode(each)).select(
        *[c for c in sketches.columns if c != "sketch"], "_level.percentile", "_level.latency_us"
    )


def task_sketches(tasks: DataFrame, task_set: str, key: Sequence[str]) -> DataFrame:
    """One row with the sets of tasks (by ``key``) and of their commits, for one batch."""
    task = F.concat_ws("\x1f", *key)
    return tasks.agg(
        F.lit(task_set).alias("task_set"),
        F.theta_sketch_agg(task, F.lit(LG_ENTRIES)).alias("tasks"),
        F.theta_sketch_agg("framework_commit", F.lit(LG_ENTRIES)).alias("commits"),
    )


def coverage(stored: DataFrame) -> DataFrame:
    """(task_set, commits, tasks): counts of all that is stored as completed and needed, and of what follows:
    ``covered`` is both, ``to_run`` is needed and not completed."""
    united = stored.groupBy("task_set").agg(
        F.theta_union_agg("tasks", F.lit(LG_ENTRIES)).alias("tasks"), F.theta_union_agg("commits", F.lit(LG_ENTRIES)).alias("commits")
    )

    def of(task_set: str, column: str) -> Column:
        return F.max(F.when(F.col("task_set") == task_set, F.col(column)))

    both = united.agg(*[of(name, "tasks").alias(name) for name in ("completed", "needed")],
                      *[of(name, "commits").alias(f"{name}_commits") for name in ("completed", "needed")])
    covered = F.theta_intersection("needed", "completed")
    left = F.theta_difference("needed", "completed")
    rows = [
        F.struct(F.lit(name).alias("task_set"), F.theta_sketch_estimate(tasks).alias("tasks"))
        for name, tasks in (("completed", F.col("completed")), ("needed", F.col("needed")), ("covered", covered), ("to_run", left))
    ]
    return both.select(F.explode(F.array(*rows)).alias("_row")).select("_row.*")


def set_error(exact: Column, largest: Column) -> Column:
    """How far a count may be off: three standard errors of the largest set that took part in it."""
    return F.when(largest <= 2**LG_ENTRIES, 0.0).otherwise(3 * SET_ERROR * largest)
