"""Build outcomes: success, tallies per commit, the failure budget, and the latest builds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchledger.operators.ledger import latest_by

# Fixed value: failures minus successes at which a build is not tried again.
MAX_BUILD_FAILURES = 2


def succeeded(executions: Column) -> Column:
    """Every execution returned 0; an execution without a code failed; no executions succeed."""
    return F.forall(executions, lambda e: F.coalesce(e["returnCode"] == 0, F.lit(False)))


def _tallies() -> list[Column]:
    return [F.count_if("successful").alias("successes"), F.count_if(~F.col("successful")).alias("failures")]


def framework_tallies(framework_builds: DataFrame) -> DataFrame:
    """Successes and failures per framework commit, across all instances."""
    return framework_builds.groupBy("framework_commit").agg(*_tallies())


def app_tallies(app_builds: DataFrame, framework_builds: DataFrame) -> DataFrame:
    """Successes and failures per (apps commit, framework commit), over all apps.

    An app build whose framework build is unknown counts for nothing. Counting per framework build
    first keeps the join on one row per build and apps commit.
    """
    per_build = app_builds.groupBy("framework_build_id", "apps_commit").agg(*_tallies())
    commits = framework_builds.select("framework_build_id", "framework_commit")
    return (
        per_build.join(commits, "framework_build_id")
        .groupBy("apps_commit", "framework_commit")
        .agg(F.sum("successes").alias("successes"), F.sum("failures").alias("failures"))
    )


def over_budget(max_failures: int = MAX_BUILD_FAILURES) -> Column:
    return F.col("failures") - F.col("successes") >= max_failures


def _kept(builds: DataFrame, columns: list[str]) -> list[str]:
    """``columns``, and whether the build's output is still there if the table tells."""
    return [*columns, "artefact_present"] if "artefact_present" in builds.columns else columns


def latest_framework_builds(framework_builds: DataFrame) -> DataFrame:
    """The last framework build of every instance."""
    return latest_by(
        framework_builds,
        ["instance_id"],
        ["end_time", "framework_build_id"],
        _kept(framework_builds, ["framework_build_id", "framework_commit", "successful"]),
    )


def latest_app_builds(app_builds: DataFrame, framework_builds: DataFrame) -> DataFrame:
    """The last build of every app on every instance."""
    instances = framework_builds.select("framework_build_id", "instance_id")
    kept = _kept(app_builds, ["apps_commit", "successful"])
    # The last build per framework build and app first: it shrinks the table before the join.
    candidates = latest_by(
        app_builds,
        ["framework_build_id", "app_name"],
        ["end_time", "app_build_id"],
        ["app_build_id", "end_time", *kept],
    )
    return latest_by(
        candidates.join(instances, "framework_build_id"),
        ["instance_id", "app_name"],
        ["end_time", "app_build_id"],
        ["app_build_id", "framework_build_id", *kept],
    )
