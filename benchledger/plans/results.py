"""From captured text to one result per commit and test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchledger.functions import parse
from benchledger.operators.ledger import join_builds, latest_by, likely
from benchledger.session import settle

# Fixed value: what a report says of a run without captured output.
NO_STDOUT = "<no wrk stdout for test run>"

METRICS = ["requests_per_second", "latency_mean_ms", "latency_p95_ms"]


def run_outcomes(test_runs: DataFrame) -> DataFrame:
    """Each run's metrics, or why it has none.

    ``outcome`` is ``ok``, ``errors``, ``no_rate``, ``no_stdout``, ``missing_json`` or
    ``parse_failed``. This is done where the run is scanned: what later moves through joins and
    aggregations is a few numbers instead of the captured text.
    """
    parsed = parse.parse_output(test_runs.select("test_run_id", "app_build_id", "test_name", "end_time", "stdout"))
    output = F.col("output")
    rps, mean_ms, p95_ms = parse.metric_columns(output)
    clean = parse.error_free(output)
    status = F.col("parse_status")
    outcome = (
        F.when(status != "parsed", status)
        .when(~clean, "errors")
        .when(output["summary"]["duration"] == 0, "no_rate")
        .otherwise("ok")
    )
    message = (
        F.when(status == "no_stdout", F.lit(NO_STDOUT))
        .when(status == "missing_json", F.lit(parse.MISSING_JSON))
        .when(status == "parse_failed", F.concat(F.lit(parse.PARSE_FAILED), F.col("json_text")))
        .otherwise(parse.error_messages(output))
    )
    read = F.struct(
        outcome.alias("outcome"),
        message.alias("message"),
        *[F.when(clean, metric).alias(name) for metric, name in zip((rps, mean_ms, p95_ms), METRICS, strict=True)],
    )
    return parse.compute_once(parsed, "_read", read).select(
        "test_run_id", "app_build_id", "test_name", "end_time", "_read.*"
    )


def valid_results(test_runs: DataFrame, app_builds: DataFrame, framework_builds: DataFrame) -> DataFrame:
    """Joined runs that parsed, had no errors and have a rate."""
    ok = run_outcomes(test_runs).filter(F.col("outcome") == "ok").drop("outcome", "message")
    builds = join_builds(app_builds, framework_builds).select("app_build_id", "instance_id", "framework_commit")
    return ok.join(builds, "app_build_id").drop("app_build_id")


def current_results(valid: DataFrame) -> DataFrame:
    """The last valid run per instance, commit and test."""
    return latest_by(
        valid,
        ["instance_id", "framework_commit", "test_name"],
        ["end_time", "test_run_id"],
        ["test_run_id", *METRICS],
    )


def windowed_results(
    test_runs: DataFrame,
    app_builds: DataFrame,
    framework_builds: DataFrame,
    commits: DataFrame,
    instance_id: int | str | None = None,
) -> DataFrame:
    """Current results of the commits in a report, optionally of one instance.

    The builds are narrowed first and the runs by them where they are scanned, so only the text of runs in the report
    (and of few others) is decoded, and none is shuffled.
    """
    if instance_id is not None:
        framework_builds = framework_builds.filter(F.col("instance_id") == instance_id)
    reported = commits.select(F.col("commit_id").alias("framework_commit")).distinct()
    framework_builds = framework_builds.join(reported, "framework_commit", "left_semi")
    builds = _result_builds(app_builds, framework_builds)
    shown = likely(test_runs, "app_build_id", builds)
    ok = run_outcomes(shown).filter(F.col("outcome") == "ok").drop("outcome", "message")
    return current_results(ok.join(builds, "app_build_id").drop("app_build_id"))


def _result_builds(app_builds: DataFrame, framework_builds: DataFrame) -> DataFrame:
    builds = join_builds(app_builds, framework_builds)
    return settle(builds.select("app_build_id", "instance_id", "framework_commit"), "builds")


def overwritten_results(valid: DataFrame) -> DataFrame:
    """Keys for which a later run replaced an earlier one."""
    return (
        valid.groupBy("instance_id", "framework_commit", "test_name")
        .agg(F.count("*").alias("runs"))
        .filter("runs > 1")
    )


def last_outcomes(
    test_runs: DataFrame, app_builds: DataFrame, framework_builds: DataFrame, wanted: DataFrame | None = None
) -> DataFrame:
    """The last run per instance, commit and test, whatever came of it.

    With ``wanted`` (instance_id, framework_commit) only of those, and of other runs hardly any text is decoded.
    """
    if wanted is None:
        builds = join_builds(app_builds, framework_builds).select("app_build_id", "instance_id", "framework_commit")
    else:
        framework_builds = framework_builds.join(wanted, ["instance_id", "framework_commit"], "left_semi")
        builds = _result_builds(app_builds, framework_builds)
        test_runs = likely(test_runs, "app_build_id", builds)
    return latest_by(
        run_outcomes(test_runs).join(builds, "app_build_id"),
        ["instance_id", "framework_commit", "test_name"],
        ["end_time", "test_run_id"],
        ["test_run_id", "outcome", "message", *METRICS],
    )
