"""Order-dependent operators that never put a whole group into one task.

A window without a partition key, or with a few hot keys, sorts each group in a single task. The
functions here range-partition the rows, work inside the bounded blocks and shift every block by
what came before it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchledger.session import settle

# Rows per block: not worth a task of its own below, split further above.
SMALL_BLOCK = 30_000
LARGE_BLOCK = 5_000_000


def number_rows(df: DataFrame, order: Sequence[Column], partition: Sequence[str] = (), few_keys: bool = False) -> DataFrame:
    """Add ``seq``, the 1-based row number in ``order`` within ``partition``.

    ``order`` must be total within a partition and ``partition`` columns must not be null. A range
    shuffle puts neighbours together; each block is sorted and numbered where it lies, and written,
    which pins the block borders. What comes before a block is then one small row per block and key.
    ``df`` is read three times (counted, sampled, sorted); pass a written table. With ``few_keys`` that
    small table goes to every task, and the rows are not shuffled again.
    """
    keys = list(partition)
    blocks = _block_count(df)
    sort = [*[F.col(k) for k in keys], *order]
    placed = settle(
        df.repartitionByRange(blocks, *sort)
        .sortWithinPartitions(*sort)
        .withColumn("_block", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id()),
        "placed",
    )
    sizes = placed.groupBy(*keys, "_block").agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
    shifts = sizes.select(
        *keys, "_block", (_before(F.col("_rows"), keys) - F.col("_first") + 1).alias("_shift")
    )
    return placed.join(F.broadcast(shifts) if few_keys else shifts, [*keys, "_block"]).select(
        *df.columns, (F.col("_row") + F.col("_shift")).alias("seq")
    )


def _block_count(df: DataFrame) -> int:
    """As many blocks as the session has shuffle partitions, but few for few rows, and more where
    blocks would grow beyond what a task sorts well."""
    rows = df.count()
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(math.ceil(rows / SMALL_BLOCK), usual), math.ceil(rows / LARGE_BLOCK))


def prefix_sums(
    df: DataFrame,
    sums: dict[str, str],
    seq: str = "seq",
    partition: Sequence[str] = (),
    block_rows: int = 100_000,
) -> DataFrame:
    """Add sums over all earlier rows (exclusive): new column to existing whole-number column.

    ``seq`` numbers the rows of a partition from 1 without gaps, so its ranges are blocks of known
    size. ``df`` is read twice; pass a written table.
    """
    keys = list(partition)
    blocked = df.withColumn("_block", F.floor((F.col(seq) - 1) / block_rows))
    totals = blocked.groupBy(*keys, "_block").agg(
        *[F.sum(source).alias(f"_{target}") for target, source in sums.items()]
    )
    shifts = totals.select(
        *keys, "_block", *[_before(F.col(f"_{target}"), keys).alias(f"_{target}") for target in sums]
    )
    earlier = (
        Window.partitionBy(*keys, "_block").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = blocked.select(
        "*", *[F.coalesce(F.sum(source).over(earlier), F.lit(0)).alias(f"_own_{t}") for t, source in sums.items()]
    )
    return inside.join(shifts, [*keys, "_block"]).select(
        *df.columns, *[(F.col(f"_own_{t}") + F.col(f"_{t}")).alias(t) for t in sums]
    )


def _before(amount: Column, keys: Sequence[str]) -> Column:
    """Sum over the earlier blocks of the key: at most one row per block and key, never the data."""
    blocks = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(blocks), F.lit(0))


def with_previous(
    df: DataFrame,
    columns: Sequence[str],
    seq: str = "seq",
    partition: Sequence[str] = (),
    block_rows: int = 100_000,
) -> DataFrame:
    """Add ``previous_<column>`` from the row with the preceding ``seq`` in the same partition.

    ``seq`` numbers the rows of a partition from 1 without gaps. Ranges of it are blocks of known size
    with LAG inside; the last row of each block is handed to the first of the next. ``df`` is read
    twice; pass a written table.
    """
    keys = [*partition, "_block"]
    blocked = df.withColumn("_block", F.floor((F.col(seq) - 1) / block_rows))
    borders = blocked.filter(F.col(seq) % block_rows == 0).select(
        *partition, (F.col("_block") + 1).alias("_block"), F.struct(*[F.col(c).alias(c) for c in columns]).alias("_border")
    )
    inside = Window.partitionBy(*keys).orderBy(seq)
    lagged = blocked.select("*", *[F.lag(c).over(inside).alias(f"_lag_{c}") for c in columns])
    first = (F.col(seq) - 1) % block_rows == 0
    return lagged.join(borders, keys, "left").select(
        *df.columns,
        *[F.when(first, F.col(f"_border.{c}")).otherwise(F.col(f"_lag_{c}")).alias(f"previous_{c}") for c in columns],
    )
