"""Reports: one line per planned commit, JSON per commit, and the whole report as ordered text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchledger.functions import parse, text
from benchledger.plans.results import METRICS
from benchledger.session import settle
from benchledger.sources import matrix as matrix_ops

# Fixed value: what a report says of a commit without a run.
NO_RESULT = "<no result for commit>"


def branch_series(branch_commits: DataFrame, results: DataFrame) -> DataFrame:
    """Results along each branch; a commit on several branches shows up on each."""
    commits = branch_commits.select(
        "branch", F.col("commit_id").alias("framework_commit"), "commit_time", "pos"
    )
    return commits.join(results, "framework_commit")


def reported_commits(branch_commits: DataFrame) -> DataFrame:
    return branch_commits.select("commit_id").distinct()


def reported_instances(ranges: DataFrame, commits: DataFrame) -> DataFrame:
    """(instance_id, framework_commit): what ``report_rows`` needs outcomes of."""
    lines = ranges.select("config_id", "instance_id")
    return commits.join(lines, "config_id").select("instance_id", F.col("commit_id").alias("framework_commit")).distinct()


def report_rows(
    ranges: DataFrame,
    commits: DataFrame,
    tests: DataFrame,
    outcomes: DataFrame,
    test_names: Sequence[str] = (),
) -> DataFrame:
    """Every planned (line, test, commit) with its last outcome, or ``no_result``."""
    per_test = matrix_ops.explode_tests(
        ranges.select("config_id", "instance_id", "test_names"), tests, test_names
    ).drop("app_name")
    planned = commits.select(
        "config_id", "branch", F.col("commit_id").alias("framework_commit"), "pos"
    ).join(per_test, "config_id")
    return planned.join(outcomes, ["instance_id", "framework_commit", "test_name"], "left").withColumn(
        "outcome", F.coalesce("outcome", F.lit("no_result"))
    )


def line_text() -> Column:
    """Short id and the first thing there is to say: metrics, or why there are none."""
    shown = (
        F.when(F.col("outcome") == "ok", parse.display(*[F.col(m) for m in METRICS]))
        .when(F.col("outcome") == "no_result", F.lit(NO_RESULT))
        .when(F.col("outcome") == "no_rate", F.lit("<no rate: zero duration>"))
        .otherwise(F.col("message"))
    )
    return F.concat(text.short_id(F.col("framework_commit")), F.lit(" "), shown)


def report_lines(
    rows: DataFrame, ranges: DataFrame, commits: DataFrame, tests: DataFrame, test_names: Sequence[str] = ()
) -> DataFrame:
    """Text lines with their order: (config_id, test_name, pos, line). A header has position -1.

    Fixed value: the form of the header.
    """
    sizes = commits.groupBy("config_id").agg(F.count("*").alias("_commits"))
    headers = (
        matrix_ops.explode_tests(ranges.select("config_id", "branch", "test_names"), tests, test_names)
        .join(sizes, "config_id", "left")
        .select(
            "config_id",
            "test_name",
            F.lit(-1).cast("bigint").alias("pos"),
            F.concat(
                F.lit("=== Test "), "test_name", F.lit(" on "), "branch", F.lit(" - "),
                F.coalesce("_commits", F.lit(0)).cast("string"), F.lit(" commits ==="),
            ).alias("line"),
        )
    )
    return headers.unionByName(rows.select("config_id", "test_name", "pos", line_text().alias("line")))


def _result_json() -> Column:
    """One result. The key names of the report file."""
    return F.struct(
        F.col("test_run_id").alias("run"),
        F.col("requests_per_second").alias("req/s"),
        F.col("latency_mean_ms").alias("latMean"),
        F.col("latency_p95_ms").alias("lat95"),
    )


def json_per_commit(results: DataFrame) -> DataFrame:
    """(instance_id, framework_commit, tests, json): all results of a commit as one object keyed by test.

    ``results`` holds one row per instance, commit and test, so a group is no larger than the list of tests.
    """
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("test_name", _result_json()))))
    return (
        results.groupBy("instance_id", "framework_commit")
        .agg(F.count("*").alias("tests"), entries.alias("_entries"))
        .select("instance_id", "framework_commit", "tests", F.to_json("_entries").alias("json"))
    )


def _quoted(value: Column) -> Column:
    """A JSON string literal."""
    return F.regexp_replace(F.to_json(F.array(value)), "^\\[|\\]$", "")


def _lines(df: DataFrame, section: int, name: Column, ordinal: Column, line: Column) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"),
        name.alias("name"),
        ordinal.cast("bigint").alias("ordinal"),
        line.alias("line"),
    )


def _with_comma(df: DataFrame, name: str) -> DataFrame:
    """Add ``comma``, empty for the row with the smallest name: one aggregated value, joined back."""
    first = df.agg(F.min(name).alias(name)).withColumn("_first", F.lit(True))
    return df.join(first, name, "left").withColumn(
        "comma", F.when(F.col("_first"), F.lit("")).otherwise(F.lit(","))
    )


def report_document(
    branch_commits: DataFrame,
    tests: DataFrame,
    results: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    prefix: str = "",
    suffix: str = "",
) -> DataFrame:
    """The whole report as ordered pieces: (section, name, ordinal, line).

    The lines in order of the first three columns are one JSON document {start, end, branches,
    tests, results}. No task ever holds the document: the largest piece is one commit.
    """

    def millis(moment: dt.datetime) -> int:
        return int(moment.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)

    one = results.sparkSession.range(1)
    fixed = [
        (0, f'{prefix}{{"start":{millis(start)},"end":{millis(end)},"branches":{{'),
        (2, '},"tests":{'),
        (4, '},"results":{'),
        (6, f"}}}}{suffix}"),
    ]
    pieces = [_lines(one, section, F.lit(""), F.lit(0), F.lit(line)) for section, line in fixed]

    branch = F.col("branch")
    spans = _with_comma(branch_commits.groupBy("branch").agg(F.max("pos").alias("last")), "branch")
    pieces.append(_lines(spans, 1, branch, F.lit(-1), F.concat("comma", _quoted(branch), F.lit(":["))))
    pieces.append(_lines(spans, 1, branch, F.col("last") + 1, F.lit("]")))
    commit = F.struct(
        F.col("commit_id").alias("commit"),
        F.unix_millis(F.col("commit_time").cast("timestamp")).alias("time"),
    )
    separator = F.when(F.col("pos") == 0, F.lit("")).otherwise(F.lit(","))
    pieces.append(_lines(branch_commits, 1, branch, F.col("pos"), F.concat(separator, F.to_json(commit))))

    test = F.col("test_name")
    described = F.concat("comma", _quoted(test), F.lit(":"), _quoted(F.col("description")))
    pieces.append(_lines(_with_comma(tests, "test_name"), 3, test, F.lit(0), described))

    commit_id = F.col("framework_commit")
    # Written, because the first commit has to be known before any line can be composed.
    per_commit = _with_comma(settle(json_per_commit(results), "json"), "framework_commit")
    pieces.append(_lines(per_commit, 5, commit_id, F.lit(0), F.concat("comma", _quoted(commit_id), F.lit(":"), "json")))
    return reduce(DataFrame.unionByName, pieces)


def report_js(branch_commits: DataFrame, tests: DataFrame, results: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """The report as the script file that the results page loads. Fixed value: the name it assigns to."""
    return report_document(branch_commits, tests, results, start, end, "var report = ", ";")


def write_lines(lines: DataFrame, order: list[str], path: str) -> None:
    """Write ``line`` as text. The part files, read in name order, hold the lines in order."""
    lines.orderBy(*order).select("line").write.text(path)
