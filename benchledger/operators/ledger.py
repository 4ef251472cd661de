"""The three record tables: their join, broken references, and the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_builds(app_builds: DataFrame, framework_builds: DataFrame) -> DataFrame:
    """App builds with the framework build they used; dangling references drop."""
    framework = framework_builds.select(
        "framework_build_id", "instance_id", "framework_commit"
    )
    return app_builds.select("app_build_id", "framework_build_id", "app_name", "apps_commit").join(
        framework, "framework_build_id"
    )


def join_runs(test_runs: DataFrame, app_builds: DataFrame, framework_builds: DataFrame) -> DataFrame:
    """Run, app build and framework build on one row; inner, so dangling references drop.

    The two build tables meet first, so the large run table is shuffled once and not twice.
    """
    return test_runs.join(join_builds(app_builds, framework_builds), "app_build_id")


#: 64-bit words of the filter that ``likely`` broadcasts, 4 MB at most.
FILTER_WORDS = 2**18


def likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key may be in ``wanted``: all that are, and some others. To be used ahead of a join on the key.

    The keys' hashes are bits in a table of bounded size that goes to every task, so rows that cannot join are
    dropped where they are scanned. With more keys more rows pass, and none is lost. ``wanted`` is read once
    more; pass a written table.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(FILTER_WORDS * 64))
    word, place = F.shiftright(bit, 6), (bit % 64).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    words = wanted.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_mask"))
    return rows.join(F.broadcast(words), (word == F.col("_word")) & (F.getbit("_mask", place) == 1), "left_semi")


def dangling_runs(test_runs: DataFrame, app_builds: DataFrame, framework_builds: DataFrame) -> DataFrame:
    """Runs that ``join_runs`` drops, with the reference that leads nowhere."""
    known = framework_builds.select("framework_build_id", F.lit(True).alias("_framework"))
    builds = app_builds.select("app_build_id", "framework_build_id").join(known, "framework_build_id", "left")
    joined = test_runs.select("test_run_id", "app_build_id").join(builds, "app_build_id", "left")
    return joined.filter(F.col("_framework").isNull()).select(
        "test_run_id",
        "app_build_id",
        F.when(F.col("framework_build_id").isNull(), "no app build")
        .otherwise("no framework build")
        .alias("reason"),
    )


def latest_by(
    df: DataFrame, keys: Sequence[str], recency: Sequence[str | Column], values: Sequence[str]
) -> DataFrame:
    """One row per key: the row with the greatest ``recency``.

    An aggregation and not a ranked window: map-side combining reduces a hot key before the shuffle.
    """
    newest = F.max_by(
        F.struct(*values), F.struct(*[F.col(r) if isinstance(r, str) else r for r in recency])
    )
    return df.groupBy(*keys).agg(newest.alias("_latest")).select(*keys, "_latest.*")


def unique_key_violations(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")
