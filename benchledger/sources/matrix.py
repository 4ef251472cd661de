"""The test matrix: which tests run on which revisions of which branch."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchledger.functions import times

MATRIX_SCHEMA = (
    "config_id int, instance_id string, branch string, revision_range string, sampling double, "
    "apps_branch string, apps_revision string, test_names array<string>"
)
COMMIT_LOG_SCHEMA = "branch string, commit_id string, epoch_seconds bigint, parents array<string>"
TESTS_SCHEMA = "test_name string, app_name string, description string, wrk_args array<string>"


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MATRIX_SCHEMA).option("multiLine", True).json(path)


def read_tests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TESTS_SCHEMA).option("multiLine", True).json(path)


def read_commit_log(spark: SparkSession, path: str) -> DataFrame:
    """(branch, commit_id, commit_time, parents) from records that give the time in epoch seconds."""
    log = spark.read.schema(COMMIT_LOG_SCHEMA).json(path)
    return log.select("branch", "commit_id", times.commit_time(F.col("epoch_seconds")).alias("commit_time"), "parents")


def range_parts(revision_range: Column) -> Column:
    """Pieces around ``..``; empty pieces at the end do not count."""
    pieces = F.split(revision_range, "\\.\\.")
    used = F.array_max(F.transform(pieces, lambda piece, i: F.when(piece != "", i + 1).otherwise(F.lit(0))))
    return F.slice(pieces, F.lit(1), used)


def keep_members(df: DataFrame, column: str, wanted: Sequence[str]) -> DataFrame:
    """Rows whose column is among ``wanted``; an empty list keeps everything."""
    return df.filter(F.col(column).isin(list(wanted))) if wanted else df


def with_range(matrix: DataFrame) -> DataFrame:
    """Split the range into ``start_revision`` and ``end_revision``; lines with another shape drop."""
    parts = range_parts(F.col("revision_range"))
    return (
        matrix.withColumn("_parts", parts)
        .filter(F.size("_parts") == 2)
        .select(
            *[c for c in matrix.columns if c != "revision_range"],
            F.get("_parts", F.lit(0)).alias("start_revision"),
            F.get("_parts", F.lit(1)).alias("end_revision"),
        )
    )


def valid_lines(matrix: DataFrame) -> DataFrame:
    """Lines that keep the rules: sampling within [0, 1], a range of exactly two parts."""
    return with_range(matrix.filter(F.col("sampling").between(0.0, 1.0)))


def explode_tests(matrix: DataFrame, tests: DataFrame, test_names: Sequence[str] = ()) -> DataFrame:
    """One row per line and test, with the test's app. Unknown tests drop; ``violations`` names them."""
    named = matrix.select(
        *[c for c in matrix.columns if c != "test_names"], F.explode("test_names").alias("test_name")
    )
    apps = tests.select("test_name", "app_name")
    return keep_members(named, "test_name", test_names).join(apps, "test_name")


def violations(matrix: DataFrame, tests: DataFrame, report_branches: DataFrame) -> DataFrame:
    """(check_name, subject, occurrences) of every broken rule of a matrix."""

    def found(rows: DataFrame, check: str, subject: Column) -> DataFrame:
        return (
            rows.groupBy(subject.cast("string").alias("subject"))
            .agg(F.count("*").alias("occurrences"))
            .select(F.lit(check).alias("check_name"), "subject", "occurrences")
        )

    used = matrix.select(F.explode("test_names").alias("test_name"))
    # Distinct right sides: a test or branch that most lines name is combined before the shuffle.
    scheduled = used.distinct()
    covered = matrix.select("branch").distinct()
    checks = [
        found(matrix.filter(~F.col("sampling").between(0.0, 1.0)), "sampling out of range", F.col("config_id")),
        found(
            matrix.filter(F.size(range_parts(F.col("revision_range"))) != 2),
            "range without two parts",
            F.col("config_id"),
        ),
        found(used.join(tests, "test_name", "left_anti"), "unknown test", F.col("test_name")),
        found(tests.join(scheduled, "test_name", "left_anti"), "unscheduled test", F.col("test_name")),
        found(tests, "duplicate test", F.col("test_name")).filter("occurrences > 1"),
        found(report_branches.join(covered, "branch", "left_anti"), "report branch not in matrix", F.col("branch")),
    ]
    return reduce(DataFrame.unionByName, checks)


def distinct_branches(matrix: DataFrame) -> DataFrame:
    """Branches to keep up to date: (role, branch)."""
    framework = matrix.select(F.lit("framework").alias("role"), "branch")
    apps = matrix.select(F.lit("apps").alias("role"), F.col("apps_branch").alias("branch"))
    return framework.unionByName(apps).distinct()
