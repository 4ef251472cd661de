"""Every operator as a query over the test data. Each callable takes (spark, sf_dir)."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchledger import fixtures as fx
from benchledger.functions import commands, parse, text, times, variant
from benchledger.operators import builds, chain_index, commits, ledger, reachability, samples, sketches
from benchledger.plans import commands as cmd
from benchledger.plans import report, results, tasks
from benchledger.session import beside, delete, new_path, settle, shuffles_removed
from benchledger.sources import compaction, layouts, matrix, records
from benchledger.streaming import incremental

REPORT_END = dt.datetime(2001, 8, 1, 12, 30)
REPORT_LENGTH = dt.timedelta(days=1200)
REPORT_START = times.window_start(REPORT_END, REPORT_LENGTH)
REPORT_INSTANCE = 7
TOP_TASKS = 50
BUDGET_SECONDS = 200_000
LOAD_OVERRIDE_SECONDS = 45
WARM_UP_SECONDS = 24 * 3600
CAPTURE_LIMIT = 1000
SKETCH_ACCURACY = 50
# The test logs fit one block; so many make walks and ranges cross borders.
BLOCKS = 3
# Blocks of the log with long side branches, 25 for each of its branches.
SIDE_BLOCKS = 100
PLACEHOLDERS = {
    "<assets.home>": "/srv/assets",
    "<apps.home>": "/srv/apps",
    "<server.url>": "http://localhost:9000",
}

Query = Callable[[SparkSession, str], DataFrame]


# --- inputs shared by several queries ------------------------------------------------------------


def _head_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    walks = fx.refs(spark, sf_dir).select(
        F.col("head").alias("walk_id"), "branch", F.col("head").alias("commit_id")
    )
    return commits.first_parent_log(commits.commit_blocks(fx.commit_log(spark, sf_dir), least_blocks=BLOCKS), walks)


def _branch_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits in the report: each branch back to the start of the window."""
    return commits.log_to_date(settle(_head_chain(spark, sf_dir), "chain"), REPORT_START)


def _tables(spark: SparkSession, sf_dir: str) -> cmd.Tables:
    return cmd.Tables(
        framework_builds=fx.framework_builds(spark, sf_dir),
        app_builds=fx.app_builds(spark, sf_dir),
        test_runs=fx.test_runs(spark, sf_dir),
        commit_log=fx.commit_log(spark, sf_dir),
        refs=fx.refs(spark, sf_dir),
        apps_log=fx.apps_log(spark, sf_dir),
        apps_refs=fx.apps_refs(spark, sf_dir),
        matrix=fx.plan_config(spark, sf_dir),
        tests=fx.tests(spark),
    )


def _needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cmd.needed(_tables(spark, sf_dir))


def _to_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cmd.to_run(_tables(spark, sf_dir))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.valid_results(
        fx.test_runs(spark, sf_dir), fx.app_builds(spark, sf_dir), fx.framework_builds(spark, sf_dir)
    )


def _window_results(spark: SparkSession, sf_dir: str, branch_commits: DataFrame) -> DataFrame:
    """Current results of one instance within the report."""
    tables = _tables(spark, sf_dir)
    return results.windowed_results(
        tables.test_runs, tables.app_builds, tables.framework_builds, branch_commits, REPORT_INSTANCE
    )


# --- runs: joins, parsing, results ---------------------------------------------------------------


def report_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.current_results(_valid(spark, sf_dir))


def report_window_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_results(spark, sf_dir, _branch_commits(spark, sf_dir))


def runs_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = fx.test_runs(spark, sf_dir).select("test_run_id", "app_build_id", "test_name")
    return ledger.join_runs(runs, fx.app_builds(spark, sf_dir), fx.framework_builds(spark, sf_dir))


def _bucketed(spark: SparkSession, sf_dir: str) -> layouts.BucketedLedger:
    path = new_path(spark, "bucketed")
    buckets = max(layouts.BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stored = layouts.BucketedLedger(spark, f"ledger_{path[-32:]}", path, buckets)
    runs = fx.test_run_numbers(spark, sf_dir).select("test_run_id", "app_build_id", "test_name", "end_time", "requests")
    stored.store(runs, fx.app_builds(spark, sf_dir), fx.framework_builds(spark, sf_dir))
    return stored


def runs_joined_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with their builds, out of tables whose runs lie as the join needs them."""
    return _bucketed(spark, sf_dir).joined_runs().drop("end_time", "requests")


def latest_runs_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last run per app build and test, bucket by bucket."""
    return _bucketed(spark, sf_dir).latest_runs().select("app_build_id", "test_name", "test_run_id", "requests")


RESULT_COLUMNS = "test_run_id string, test_name string, framework_commit string, end_time timestamp_ntz, requests bigint"


def _stored_results(spark: SparkSession, sf_dir: str) -> str:
    """All runs with their builds as a partitioned ledger; a second batch stores some of them again."""
    path = new_path(spark, "results")
    runs = fx.test_run_numbers(spark, sf_dir).select("test_run_id", "app_build_id", "test_name", "end_time", "requests")
    rows = ledger.join_runs(runs, fx.app_builds(spark, sf_dir), fx.framework_builds(spark, sf_dir)).select(
        "test_run_id", "test_name", "framework_commit", "end_time", "requests", "instance_id"
    )
    layouts.store_results(rows, path, 0)
    layouts.store_results(rows.filter(F.substring("test_run_id", 1, 1) == "a").withColumn("requests", F.lit(-1).cast("bigint")), path, 1)
    return path


def _report_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half a year for each instance of one region."""
    nations = fx.table(spark, sf_dir, "nation").filter(F.col("n_regionkey") == 2)
    year = 1994 + F.col("n_nationkey").cast("int") % 3
    quarters = F.array(year * 10 + 1, year * 10 + 2)
    return nations.select(F.col("n_nationkey").cast("int").alias("instance_id"), F.explode(quarters).alias("quarter"))


def ledger_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of the instances and quarters that another table names; folders of others are not read."""
    return layouts.results_in(spark, _stored_results(spark, sf_dir), RESULT_COLUMNS, _report_windows(spark, sf_dir))


def dangling_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.dangling_runs(
        fx.test_runs(spark, sf_dir), fx.app_builds(spark, sf_dir), fx.framework_builds(spark, sf_dir)
    )


def parse_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse.parse_output(fx.test_runs(spark, sf_dir).select("test_run_id", "stdout"))
    return parsed.select("test_run_id", "parse_status", *_output_numbers(F.col("output")))


def _output_numbers(output: F.Column) -> list[F.Column]:
    errors = output["summary"]["errors"]
    return [
        output["summary"]["duration"].alias("duration_us"),
        output["summary"]["requests"].alias("requests"),
        output["summary"]["bytes"].alias("bytes"),
        *[errors[kind].alias(f"err_{kind}") for kind in ("connect", "read", "write", "status", "timeout")],
        output["latency"]["mean"].alias("latency_mean_us"),
        output["latency"]["max"].alias("latency_max_us"),
        parse.percentile_value(output["latency"], 95).alias("latency_p95_us"),
    ]


def parse_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``parse_outputs`` reads, out of a variant."""
    parsed = variant.with_variant(fx.test_runs(spark, sf_dir).select("test_run_id", "stdout"))
    return parsed.select("test_run_id", "parse_status", *_output_numbers(F.col("declared")))


def output_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of the captured outputs, of which some have one more that no schema declares."""
    runs = fx.test_runs(spark, sf_dir).select("test_run_id", F.regexp_replace("stdout", '"duration":3', '"note":{"p999":7},"duration":3').alias("stdout"))
    return variant.output_fields(variant.with_variant(runs))


def parse_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse.parse_output(fx.test_runs(spark, sf_dir).select("test_run_id", "stdout"))
    return parsed.groupBy("parse_status").agg(F.count("*").alias("runs"))


def percentile_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse.parse_output(fx.test_runs(spark, sf_dir).select("test_run_id", "stdout"))
    latency = F.col("output")["latency"]
    return parsed.filter(F.col("parse_status") == "parsed").select(
        "test_run_id",
        *[parse.percentile_value(latency, p).alias(f"p{p}") for p in (1, 50, 95, 99)],
        parse.percentile_value(latency, 42).alias("p42"),
    )


def measured_execution(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = fx.test_runs_with_executions(spark, sf_dir)
    measured = parse.measured_execution(F.col("executions"))
    return runs.select(
        "test_run_id",
        F.when(measured.isNull(), "never measured").otherwise("measured").alias("state"),
        measured["end_time"].alias("measured_end"),
        (measured["stdout"] == "warming up").alias("is_warm_up"),
    )


def error_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse.parse_output(fx.test_runs(spark, sf_dir).select("test_run_id", "stdout"))
    return parsed.filter(parse.error_free(F.col("output"))).select("test_run_id")


def error_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse.parse_output(fx.test_runs(spark, sf_dir).select("test_run_id", "stdout"))
    return parsed.filter(F.col("parse_status") == "parsed").select(
        "test_run_id", parse.error_messages(F.col("output")).alias("message")
    )


def derived_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse.parse_output(fx.test_runs(spark, sf_dir).select("test_run_id", "stdout"))
    return parsed.filter(F.col("parse_status") == "parsed").select(
        "test_run_id", *parse.metric_columns(F.col("output"))
    )


def overwritten_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.overwritten_results(_valid(spark, sf_dir))


def execution_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long the measured execution of each run took, by its start and end."""
    measured = parse.measured_execution(F.col("executions"))
    runs = fx.test_runs_with_executions(spark, sf_dir).select("test_run_id", measured.alias("measured"))
    start, end = F.col("measured.start_time"), F.col("measured.end_time")
    return runs.select(
        "test_run_id",
        times.elapsed_micros(start, end).alias("elapsed_us"),
        times.elapsed_minutes(start, end).alias("elapsed_minutes"),
    )


# --- builds ---------------------------------------------------------------------------------------


def _build_outcomes(rows: DataFrame, kind: str, key: str, sequence: F.Column) -> DataFrame:
    executions = F.when(sequence % 29 == 0, F.array().cast("array<struct<returnCode:int>>")).otherwise(
        F.array(F.struct(F.lit(0).alias("returnCode")), F.struct(F.col("return_code").cast("int").alias("returnCode")))
    )
    return rows.select(
        F.lit(kind).alias("kind"), F.col(key).alias("build_id"), builds.succeeded(executions).alias("successful")
    )


def build_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    framework = fx.framework_builds(spark, sf_dir)
    apps = fx.app_builds(spark, sf_dir)
    return _build_outcomes(framework, "framework", "framework_build_id", F.col("build_seq")).unionByName(
        _build_outcomes(apps, "app", "app_build_id", F.dayofyear("end_time"))
    )


def build_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return builds.framework_tallies(fx.framework_builds(spark, sf_dir))


def app_build_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return builds.app_tallies(fx.app_builds(spark, sf_dir), fx.framework_builds(spark, sf_dir))


def failure_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    framework = build_tallies(spark, sf_dir).filter(builds.over_budget())
    apps = app_build_tallies(spark, sf_dir).filter(builds.over_budget())
    return framework.select(
        F.lit("framework").alias("kind"), "framework_commit", F.lit(None).cast("string").alias("apps_commit"),
        "successes", "failures",
    ).unionByName(apps.select(F.lit("app").alias("kind"), "framework_commit", "apps_commit", "successes", "failures"))


def latest_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    framework = builds.latest_framework_builds(fx.framework_builds(spark, sf_dir))
    apps = builds.latest_app_builds(fx.app_builds(spark, sf_dir), fx.framework_builds(spark, sf_dir))
    return framework.select(
        F.lit("framework").alias("kind"), "instance_id", F.lit(None).cast("string").alias("app_name"),
        F.col("framework_build_id").alias("build_id"), F.col("framework_commit").alias("built_commit"), "successful",
    ).unionByName(
        apps.select(
            F.lit("app").alias("kind"), "instance_id", "app_name",
            F.col("app_build_id").alias("build_id"), F.col("apps_commit").alias("built_commit"), "successful",
        )
    )


# --- commits --------------------------------------------------------------------------------------


def first_parent_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _head_chain(spark, sf_dir).select("branch", "commit_id", "commit_time", "pos")


def _resolutions(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    tables = _tables(spark, sf_dir)
    return tasks.line_resolutions(lines, tables.commit_log, tables.refs, tables.apps_log, tables.apps_refs)


def first_parent_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = fx.plan_config(spark, sf_dir)
    blocks, lines = beside(
        lambda: commits.commit_blocks(fx.commit_log(spark, sf_dir), least_blocks=BLOCKS),
        lambda: settle(_resolutions(spark, sf_dir, config), "resolutions"),
    )
    chain, ranges = commits.shared_chains(blocks, tasks.resolved_lines(lines), fx.refs(spark, sf_dir))
    asked = ranges.select(F.col("config_id").alias("range_id"), "chain_id", "end_pos", "branch", "start_id")
    return commits.first_parent_range(blocks, chain, asked).withColumnRenamed("range_id", "config_id")


def _side_ranges(spark: SparkSession, sf_dir: str) -> tuple[commits.CommitBlocks, DataFrame, DataFrame]:
    """The log with long side branches in blocks, its chains, and starts at five places of every branch.

    Two lie on the side branch, at its end and in its middle; the others are the head, half way and the root.
    """
    log = fx.side_log(spark, sf_dir)
    blocks = commits.commit_blocks(log.select("branch", "commit_id", "commit_time", "parents"), least_blocks=SIDE_BLOCKS)
    head = F.col("top") - F.when(F.col("top") % 5 == 3, 1).otherwise(0)
    heads = log.filter(F.col("n") == head).select("branch", F.col("commit_id").alias("walk_id"), "commit_id")
    chain = settle(commits.first_parent_log(blocks, heads.select("walk_id", "branch", "commit_id")), "chain")
    side = lambda n: n - (n + 2) % 5
    half = F.floor(F.col("top") / 2)
    places = F.array(side(F.col("top")), side(half), head, side(half) + 2, F.lit(1)).cast("array<bigint>")
    wanted = log.groupBy("branch").agg(F.max("top").alias("top")).select("branch", F.posexplode(places).alias("place", "n"))
    ranges = wanted.join(log.select("branch", "n", F.col("commit_id").alias("start_id")), ["branch", "n"]).join(
        heads.select("branch", "walk_id"), "branch"
    )
    named = F.concat_ws("-", "branch", "place").alias("range_id")
    return blocks, chain, settle(ranges.select(named, "walk_id", "branch", "start_id"), "ranges")


def range_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest commit on the history of the head that a start reaches, through a side branch over many blocks."""
    return reachability.range_cuts(*_side_ranges(spark, sf_dir))


def log_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _branch_commits(spark, sf_dir).select("branch", "commit_id", "commit_time", "pos")


def _appended_index(spark: SparkSession, sf_dir: str) -> tuple[chain_index.ChainIndex, DataFrame]:
    """An index of the history, made of three batches of each branch, and walks from the heads."""
    log = fx.commit_log(spark, sf_dir)
    tops = settle(log.groupBy("branch").agg(F.max("n").alias("_top")), "tops")
    parts = log.join(F.broadcast(tops), "branch").withColumn("_batch", F.least(F.floor(F.col("n") * 3 / F.col("_top")), F.lit(2))).drop("_top")
    index = chain_index.ChainIndex(spark, new_path(spark, "chain_index"))
    for batch in range(3):
        new = parts.filter(F.col("_batch") == batch)
        heads = new.groupBy("branch").agg(F.max_by("commit_id", "n").alias("head"))
        chain_index.append(index, new, settle(heads, "heads"), batch, least_blocks=BLOCKS if batch == 0 else 1)
    walks = fx.refs(spark, sf_dir).select(F.col("head").alias("walk_id"), "branch", F.col("head").alias("commit_id"))
    return index, walks


def chain_index_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of every head out of the stored index."""
    return chain_index.stored_log(*_appended_index(spark, sf_dir)).select("branch", "commit_id", "commit_time", "pos")


def chain_index_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's commits out of the stored index, whose older batches need not be read."""
    index, walks = _appended_index(spark, sf_dir)
    return chain_index.stored_log(index, walks, REPORT_START).select("branch", "commit_id", "commit_time", "pos")


def chain_index_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commits to test, planned from the stored index."""
    index, _ = _appended_index(spark, sf_dir)
    return cmd.planned_commits(dataclasses.replace(_tables(spark, sf_dir), chain_index=index)).commits


def commit_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cmd.planned_commits(_tables(spark, sf_dir)).commits


def commit_sample_monotone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits per sampling rate, and how many a lower rate keeps that this one loses (none)."""
    log = fx.commit_log(spark, sf_dir).select("commit_id")
    rates = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    picked = [commits.sampled(F.col("commit_id"), F.lit(rate)) for rate in rates]
    counted = log.agg(
        F.array(
            *[
                F.struct(
                    F.lit(rate).alias("rate"),
                    F.count_if(picked[i]).alias("commits"),
                    F.count_if(picked[max(i - 1, 0)] & ~picked[i]).alias("lost"),
                )
                for i, rate in enumerate(rates)
            ]
        ).alias("_rates")
    )
    return counted.select(F.explode("_rates").alias("_rate")).select("_rate.*")


def resolve_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HEAD of every branch, and every commit by its full id and by beginnings of several lengths."""
    log = fx.commit_log(spark, sf_dir)
    names = F.array("commit_id", *[F.substring("commit_id", 1, length) for length in (2, 4, 5, 6, 7, 12)])
    wanted = (
        log.select("branch", F.explode(names).alias("revision"))
        .union(log.select("branch", F.lit("HEAD")))
        .union(log.select("branch", F.concat(F.lit("-"), text.short_id(F.col("commit_id")))))
        .distinct()
    )
    return commits.resolve_revisions(wanted, log, fx.refs(spark, sf_dir))


def reported_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.reported_commits(_branch_commits(spark, sf_dir))


def branch_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    branch_commits = settle(_branch_commits(spark, sf_dir), "branch_commits")
    current = _window_results(spark, sf_dir, branch_commits)
    return report.branch_series(branch_commits, current).drop("instance_id")


def missing_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag difference: every matrix line asks for its branch, every supplier provides one ref."""
    configured = fx.raw_matrix(spark, sf_dir).select("branch")
    known = fx.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("refs/heads/Brand#"), (F.col("s_suppkey") % 25 + 1).cast("string")).alias("ref_name")
    )
    return commits.missing_branches(configured, known)


# --- matrix and plan ------------------------------------------------------------------------------


def matrix_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = matrix.valid_lines(fx.raw_matrix(spark, sf_dir))
    return matrix.explode_tests(lines, fx.tests(spark))


def matrix_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.raw_matrix(spark, sf_dir)
    report_branches = fx.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("Brand#"), (F.col("n_nationkey") + 3).cast("string")).alias("branch")
    )
    return matrix.violations(lines, fx.tests(spark), report_branches)


def matrix_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.distinct_branches(fx.raw_matrix(spark, sf_dir))


def unresolved_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines over the parts whose revisions are short beginnings of ids, some of no or of several commits."""
    lines = fx.vague_matrix(spark, sf_dir)
    return tasks.unresolved_lines(_resolutions(spark, sf_dir, lines))


def filter_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = matrix.keep_members(fx.raw_matrix(spark, sf_dir), "branch", ["Brand#2", "Brand#3", "Brand#5"])
    lines = matrix.keep_members(lines, "apps_branch", [])
    return matrix.explode_tests(lines, fx.tests(spark), ["A-F", "N-F"]).select("config_id", "branch", "test_name")


def needed_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _needed(spark, sf_dir)


def tasks_to_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _to_run(spark, sf_dir).drop("is_current")


def coverage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = settle(_needed(spark, sf_dir), "needed")
    tables = _tables(spark, sf_dir)
    counted = settle(tasks.run_counts(tables.test_runs, tables.app_builds, tables.framework_builds), "run_counts")
    return tasks.coverage_counts(counted, needed, tasks.tasks_to_run(needed, counted.select(*tasks.TASK_KEY)))


def plan_order_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cmd.plan(_tables(spark, sf_dir))


def plan_order_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cmd.plan(_tables(spark, sf_dir), tasks.PlanOptions(lexical_order=True))


def plan_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.first_tasks(_to_run(spark, sf_dir), TOP_TASKS)


def budgeted_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = tasks.PlanOptions(max_total_seconds=BUDGET_SECONDS, max_load_seconds=LOAD_OVERRIDE_SECONDS)
    return cmd.plan(_tables(spark, sf_dir), limits)


def rebuild_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.rebuild_points(cmd.plan(_tables(spark, sf_dir))).select(
        "instance_id", "seq", "framework_commit", "app_name", "apps_commit",
        "framework_build", "framework_rebuild", "app_rebuild",
    )


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    framework, apps = fx.framework_builds(spark, sf_dir), fx.app_builds(spark, sf_dir)
    return tasks.rebuild_decisions(
        _needed(spark, sf_dir),
        builds.latest_framework_builds(framework),
        builds.latest_app_builds(apps, framework),
    )


def rebuild_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decisions(spark, sf_dir)


def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    skipped = tasks.skip_reasons(_decisions(spark, sf_dir), build_tallies(spark, sf_dir), app_build_tallies(spark, sf_dir))
    return skipped.select("instance_id", *tasks.TASK_KEY, "apps_branch", "apps_commit", "skip_reason")


def render_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = tasks.rendered_commands(
        _needed(spark, sf_dir), fx.tests(spark), PLACEHOLDERS, "<apps.home>", LOAD_OVERRIDE_SECONDS
    )
    command = F.col("command")
    return rendered.select(
        "instance_id", *tasks.TASK_KEY, "apps_branch", "apps_commit",
        command["program"].alias("program"),
        F.array_join(command["args"], " ").alias("args"),
        command["workingDir"].alias("working_dir"),
        "timeout_ms",
    )


def effective_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured seconds per part line, cut down to an override where there is one."""
    lines = fx.table(spark, sf_dir, "part")
    configured = (F.col("p_size") * 10).cast("bigint")
    override = F.when(F.col("p_partkey") % 3 != 0, F.col("p_partkey") % 400).cast("bigint")
    return lines.select("p_partkey", commands.effective_duration(configured, override).alias("seconds"))


# --- reports --------------------------------------------------------------------------------------


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as data: one row per line of text, with numbers instead of the text."""
    tables = _tables(spark, sf_dir)
    planned = cmd.planned_commits(tables)
    wanted = report.reported_instances(planned.ranges, planned.commits)
    outcomes = results.last_outcomes(tables.test_runs, tables.app_builds, tables.framework_builds, wanted)
    return report.report_rows(planned.ranges, planned.commits, tables.tests, outcomes).select(
        "config_id", "instance_id", "branch", "framework_commit", "pos", "test_name", "outcome", *results.METRICS
    )


def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cmd.print_report(_tables(spark, sf_dir))


def report_text_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's lines read back: numbers as numbers, and what else a line says."""
    line = F.col("line")
    labels = {"requests_per_second": "Requests/s", "latency_mean_ms": "Mean latency", "latency_p95_ms": "Latency 95%"}
    numbers = [
        F.nullif(F.regexp_extract(line, label + r": ([0-9.E+-]+)", 1), F.lit("")).cast("double").alias(name)
        for name, label in labels.items()
    ]
    # All that a line says; only numbers of metrics are left out, as they are read apart.
    rest = F.substr(line, F.lit(9))
    frame = F.regexp_replace(rest, r": [0-9.E+-]+", ": #")
    said = F.when(F.col("pos") < 0, line).when(rest.startswith("Requests/s"), frame).otherwise(rest)
    return report_text(spark, sf_dir).select(
        "config_id", "test_name", "pos", F.when(F.col("pos") >= 0, F.substring(line, 1, 7)).alias("short_id"), said.alias("said"), *numbers
    )


def report_json_per_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.json_per_commit(report_window_results(spark, sf_dir))


def report_json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON of every commit read back into rows."""
    entries = F.from_json(
        "json", "map<string,struct<run:string,`req/s`:double,latMean:double,lat95:double>>"
    )
    return report_json_per_commit(spark, sf_dir).select(
        "framework_commit", "tests", F.explode(entries).alias("test_name", "_result")
    ).select(
        "framework_commit", "tests", "test_name",
        F.col("_result.run").alias("test_run_id"),
        F.col("_result.`req/s`").alias("requests_per_second"),
        F.col("_result.latMean").alias("latency_mean_ms"),
        F.col("_result.lat95").alias("latency_p95_ms"),
    )


def report_js(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cmd.json_report(_tables(spark, sf_dir), REPORT_INSTANCE, [], REPORT_END, REPORT_LENGTH, as_script=True)


def report_js_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of the report file read back: whether a comma leads it, and what it says.

    Commits with times, test descriptions and tests per commit as values, brackets and the frame as they are.
    """
    piece = F.regexp_replace("line", "^,", "")
    commit = F.from_json(piece, "commit string, time bigint")
    wrapped = F.concat(F.lit("{"), piece, F.lit("}"))
    described = F.get(F.map_values(F.from_json(wrapped, "map<string,string>")), F.lit(0))
    tests = F.size(F.get(F.map_values(F.from_json(wrapped, "map<string,map<string,struct<run:string>>>")), F.lit(0)))
    value = (
        F.when((F.col("section") == 1) & commit["commit"].isNotNull(), F.concat_ws("@", commit["commit"], commit["time"].cast("string")))
        .when(F.col("section") == 3, described)
        .when(F.col("section") == 5, tests.cast("string"))
        .otherwise(piece)
    )
    comma = F.col("line").startswith(",")
    return report_js(spark, sf_dir).select("section", "name", "ordinal", comma.alias("comma"), value.alias("value"))


# --- samples --------------------------------------------------------------------------------------


def sample_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.sample_totals(fx.samples(spark, sf_dir))


def sample_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.sample_stats(fx.samples(spark, sf_dir))


def sample_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.sample_percentiles(fx.samples(spark, sf_dir))


def sample_percentiles_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketched percentiles, and whether each is as near to its rank as the sketch promises."""
    rows = fx.samples(spark, sf_dir)
    sketched = settle(samples.sample_percentiles_approx(rows, accuracy=SKETCH_ACCURACY), "sketched")
    errors = samples.rank_errors(rows, sketched)
    near = F.col("rank_error") <= F.ceil(F.col("n") / SKETCH_ACCURACY)
    return errors.select("run_key", "percentile", near.alias("within_error"))


SKETCH_LEVELS = (5, 25, 50, 75, 95)
SKETCH_DAYS, SKETCH_EVERY = 30, 10


def _daily_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored sketches of three batches of samples, which split days."""
    path = new_path(spark, "sketches")
    rows = fx.samples(spark, sf_dir)
    for batch in range(3):
        part = rows.filter(F.pmod(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(3)) == batch)
        records.append_batch(sketches.daily_sketches(part), path, batch)
    return records.read_batches(spark, path, sketches.DAILY)


def sketch_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of every 30 days of a run, merged from stored sketches, and whether their ranks are right."""
    windows = sketches.sliding(_daily_sketches(spark, sf_dir), SKETCH_DAYS, SKETCH_EVERY)
    merged = sketches.merged(windows, ["run_key", "window_start"])
    # A run's window stands for a run in the check against the samples themselves.
    key = F.concat_ws("@", "run_key", "window_start")
    estimates = settle(sketches.percentiles(merged, SKETCH_LEVELS).withColumn("run_key", key), "estimates")
    rows = sketches.sliding(fx.samples(spark, sf_dir).withColumn("day", F.to_date("ts")), SKETCH_DAYS, SKETCH_EVERY)
    errors = samples.rank_errors(rows.select(key.alias("run_key"), "latency_us"), estimates.select("run_key", "percentile", "latency_us"))
    near = errors.select("run_key", "percentile", (F.col("rank_error") <= sketches.RANK_ERROR * F.col("n")).alias("within_error"))
    numbers = estimates.select("run_key", "percentile", "requests", "latency_sum_us", "min_us", "max_us")
    return numbers.join(near, ["run_key", "percentile"]).withColumnRenamed("run_key", "window")


def coverage_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task counts from sketches that each batch of runs and each half of the matrix left behind."""
    path = new_path(spark, "coverage")
    needed = settle(_needed(spark, sf_dir), "needed")
    finished = settle(_finished_tasks(spark, sf_dir), "finished")
    for batch in range(2):
        half = F.pmod(F.xxhash64("test_name"), F.lit(2)) == batch
        parts = [sketches.task_sketches(rows.filter(half), name, tasks.TASK_KEY) for name, rows in (("needed", needed), ("completed", finished))]
        records.append_batch(parts[0].unionByName(parts[1]), path, batch)
    estimated = sketches.coverage(records.read_batches(spark, path, sketches.COVERAGE))
    # The same sets, counted.
    wanted, done = needed.select(*tasks.TASK_KEY).distinct(), finished.select(*tasks.TASK_KEY).distinct()
    exact = settle(
        wanted.select("*", F.lit(True).alias("wanted")).join(done.select("*", F.lit(True).alias("done")), tasks.TASK_KEY, "full")
        .agg(F.count_if("done").alias("completed"), F.count_if("wanted").alias("needed"),
             F.count_if(F.col("wanted") & F.col("done")).alias("covered")),
        "exact",
    )
    names = ("completed", "needed", "covered", "to_run")
    counts = exact.withColumn("to_run", F.col("needed") - F.col("covered")).select(
        F.greatest("completed", "needed").alias("largest"),
        F.explode(F.array(*[F.struct(F.lit(name).alias("task_set"), F.col(name).alias("exact")) for name in names])).alias("one"),
    ).select("largest", "one.*")
    off = F.abs(F.col("tasks") - F.col("exact"))
    return estimated.join(counts, "task_set").select(
        "task_set", F.col("exact").alias("tasks"), (off <= sketches.set_error(F.col("exact"), F.col("largest"))).alias("within_error")
    )


def _finished_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = fx.test_run_numbers(spark, sf_dir).select("app_build_id", "test_name")
    return ledger.join_runs(runs, fx.app_builds(spark, sf_dir), fx.framework_builds(spark, sf_dir)).select(*tasks.TASK_KEY)


def commit_log_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history written as records with epoch seconds, and read back."""
    path = new_path(spark, "history")
    log = fx.commit_log(spark, sf_dir)
    seconds = F.unix_seconds(F.col("commit_time").cast("timestamp"))
    log.select("branch", "commit_id", seconds.alias("epoch_seconds"), "parents").write.json(path)
    return matrix.read_commit_log(spark, path).select(
        "branch", "commit_id", F.unix_seconds("commit_time").alias("seconds"), F.size("parents").alias("parents")
    )


def warmup_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.after_warm_up(fx.samples(spark, sf_dir), WARM_UP_SECONDS)


# --- text -----------------------------------------------------------------------------------------


def version_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build files made from parts: leading space, comments, later quotes, and some without a version."""
    line = F.concat(F.lit('version in ThisBuild := "'), F.col("p_size").cast("string"), F.lit('.0"'))
    kind = F.col("p_partkey") % 4
    file_text = (
        F.when(kind == 0, F.concat(F.lit("// x\n"), line))
        .when(kind == 1, F.concat(F.lit(" \t\nRelease.branchV"), F.substring(line, 2, 100), F.lit(' // "later"\n')))
        .when(kind == 2, F.concat(line, F.lit("\n\n")))
        .otherwise(F.concat(F.lit("name := "), F.col("p_name")))
    )
    return fx.table(spark, sf_dir, "part").select("p_partkey", text.version_of(file_text).alias("version"))


def cap_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", text.cap_output(F.col("text"), CAPTURE_LIMIT).alias("captured")
    )


# --- record files, ledger, streams ----------------------------------------------------------------


def _write_records(spark: SparkSession, sf_dir: str) -> str:
    """Archives of all records: some runs are damaged, and some app builds stand twice."""
    home = new_path(spark, "records")
    for name, folder in fx.LAYOUT.directories.items():
        if name == "test_runs":
            fx.write_lines(fx.damaged_documents(spark, sf_dir), f"{home}/{folder}")
        else:
            fx.write_archive(spark, sf_dir, name, f"{home}/{folder}", compressed=True)
    again = fx.record_documents(spark, sf_dir, "app_builds").filter(F.substring("id", 1, 1) == "a")
    fx.write_lines(fx.json_lines(again), f"{home}/{fx.LAYOUT.directories['app_builds']}")
    return home


def ingest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records written as archives, read back through strict decoding into native tables.

    Every record comes out once, the damaged ones as quarantined.
    """
    home = _write_records(spark, sf_dir)
    return _record_rows(records.load_tables(spark, home, fx.LAYOUT, archive=True, pattern="part-*"))


PACKED_BYTES = 4 * 2**20


def compacted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records out of packed archives; the app builds that stand twice are packed in a second run."""
    home, packed = new_path(spark, "records"), new_path(spark, "packed")
    files = 20 * fx.archive_scale(spark, sf_dir, 20)
    for name, folder in fx.LAYOUT.directories.items():
        if name == "test_runs":
            lines = fx.damaged_documents(spark, sf_dir, files)
        else:
            lines = fx.json_lines(fx.record_documents(spark, sf_dir, name).repartition(20))
        fx.write_lines(lines, f"{home}/{folder}")
        compaction.pack(spark, f"{home}/{folder}", f"{packed}/{name}", True, "part-*", PACKED_BYTES)
        if name == "app_builds":
            fx.write_lines(lines.filter(F.get_json_object("value", "$.id").startswith("a")), f"{home}/{folder}")
            compaction.pack(spark, f"{home}/{folder}", f"{packed}/{name}", True, "part-*", PACKED_BYTES)
    scan = lambda name: compaction.scan_packed(spark, f"{packed}/{name}", name, fx.LAYOUT, True)
    return _record_rows(records.load_tables(spark, home, fx.LAYOUT, scan=scan))


def _record_rows(tables: dict[str, DataFrame]) -> DataFrame:
    end_us = F.unix_micros("end_time").alias("end_us")
    return (
        tables["framework_builds"]
        .select(
            F.lit("framework").alias("kind"), F.col("framework_build_id").alias("record_id"),
            F.col("instance_id").alias("parent_id"), F.col("framework_commit").alias("label"), "successful", end_us,
        )
        .unionByName(
            tables["app_builds"].select(
                F.lit("app").alias("kind"), F.col("app_build_id").alias("record_id"),
                F.col("framework_build_id").alias("parent_id"), F.col("app_name").alias("label"), "successful", end_us,
            )
        )
        .unionByName(
            tables["test_runs"].select(
                F.lit("run").alias("kind"), F.col("test_run_id").alias("record_id"),
                F.col("app_build_id").alias("parent_id"), F.col("test_name").alias("label"),
                F.lit(None).cast("boolean").alias("successful"), end_us,
            )
        )
        .unionByName(
            tables["quarantine"].select(
                F.lit("quarantined").alias("kind"), _damaged_id().alias("record_id"),
                F.lit(None).cast("string").alias("parent_id"), F.col("reason").alias("label"),
                F.lit(None).cast("boolean").alias("successful"), F.lit(None).cast("bigint").alias("end_us"),
            )
        )
    )


def _damaged_id() -> F.Column:
    return F.coalesce("id", F.regexp_extract("_corrupt", '"id":"([^"]*)"', 1))


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "damaged")
    fx.write_lines(fx.damaged_documents(spark, sf_dir), path)
    scanned = records.scan_records(spark, path, "test_runs", fx.LAYOUT, archive=True, pattern="part-*")
    _, bad = records.split_records(scanned, "test_runs", fx.LAYOUT)
    return bad.select(_damaged_id().alias("record_id"), "reason")


def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that stand more than once in the archive of app builds and in that of runs."""
    home = new_path(spark, "records")
    builds_ = fx.record_documents(spark, sf_dir, "app_builds").select("id")
    builds_.union(builds_.filter(F.substring("id", 1, 1) == "a")).write.json(home)
    twice = ledger.unique_key_violations(spark.read.schema("id string").json(home), "id")
    runs = ledger.unique_key_violations(fx.test_runs(spark, sf_dir), "test_run_id").withColumnRenamed("test_run_id", "id")
    return twice.unionByName(runs)


def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All app builds, then a second batch that replaces some; the second one is stored twice."""
    path = new_path(spark, "ledger")
    rows = fx.app_builds(spark, sf_dir).select("app_build_id", "app_name", "return_code", "end_time")
    records.append_batch(rows, path, 0)
    changed = rows.filter(F.dayofyear("end_time") % 7 == 0).withColumn("return_code", F.lit(9))
    for _ in range(2):
        records.append_batch(changed, path, 1)
    schema = "app_build_id string, app_name string, return_code int, end_time timestamp_ntz"
    return records.read_ledger(spark, path, schema, "app_build_id")


def _run_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "arrivals")
    scale = fx.archive_scale(spark, sf_dir, 6)
    fx.write_archive(spark, sf_dir, "test_runs", path, 6 * scale, compressed=True)
    return incremental.stream_records(spark, path, "test_runs", fx.LAYOUT, True, 2 * scale, "part-*")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged and whole runs arrive; then a second archive brings some runs again under another test name."""
    path, target, progress = (new_path(spark, name) for name in ("arrivals", "ingested", "progress"))
    scale = fx.archive_scale(spark, sf_dir, 3)

    def arrive(lines: DataFrame, part: int) -> None:
        fx.write_lines(lines, f"{path}/{part}")
        stream = incremental.stream_records(spark, path, "test_runs", fx.LAYOUT, True, 2 * scale, "part-*")
        incremental.ingest(stream, "test_runs", target, progress, fx.LAYOUT).awaitTermination()

    arrive(fx.damaged_documents(spark, sf_dir, 3 * scale), 1)
    again = fx.record_documents(spark, sf_dir, "test_runs", 3 * scale).filter(F.substring("id", 1, 1) == "a")
    arrive(fx.json_lines(again.withColumn("testName", F.lit("again"))), 2)
    schema = (
        "test_run_id string, app_build_id string, test_name string, start_time timestamp, end_time timestamp, "
        "stdout string, executions int"
    )
    wanted = [F.col("app_build_id"), F.col("test_name"), F.col("end_time"), F.col("executions"), F.col("stdout").isNotNull().alias("has_stdout")]
    stored = records.read_ledger(spark, target, schema, "test_run_id", columns=wanted)
    bad = records.read_batches(spark, f"{target}-quarantine", records.QUARANTINE_SCHEMA)
    return stored.select(
        "test_run_id", "app_build_id", "test_name", F.unix_micros("end_time").alias("end_us"),
        "executions", "has_stdout", F.lit(None).cast("string").alias("reason"),
    ).unionByName(bad.select(_damaged_id().alias("test_run_id"), "reason"), allowMissingColumns=True)


def stream_latest_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs arrive in several micro-batches, all of them ahead of their builds."""
    state = new_path(spark, "latest")
    plain = [F.replace(c, F.lit("-"), F.lit("")).alias(c) for c in ("test_run_id", "app_build_id")]
    runs = records.native_table(
        records.split_records(_run_stream(spark, sf_dir), "test_runs", fx.LAYOUT)[0], "test_runs", fx.LAYOUT
    ).select(*plain, "test_name", "end_time", "stdout")
    incremental.keep_latest_results(runs, state, new_path(spark, "progress")).awaitTermination()
    folded = new_path(spark, "folded")
    incremental.compact_results(spark, state, folded)
    builds_ = fx.app_builds(spark, sf_dir), fx.framework_builds(spark, sf_dir)
    return incremental.read_latest_results(spark, folded, *builds_).drop("end_time")


def stream_sample_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving = spark.readStream.schema(fx.table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
    shaped = spark.sql(fx.SAMPLES, events=arriving).withColumn("ts", F.col("ts").cast("timestamp"))
    target = new_path(spark, "rolled_up")
    (
        incremental.sample_roll_up(shaped, "6 hours", "1 hour")
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", new_path(spark, "progress"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    closed = spark.read.schema(incremental.ROLLED_UP).parquet(target)
    all_samples = fx.samples(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    rolled = incremental.with_open_sessions(closed, all_samples, "6 hours")
    return rolled.withColumn("started", F.unix_micros("started")).withColumn("closed", F.unix_micros("closed"))


def stream_open_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions from the stream's output and open ones from its state; the samples are read once."""
    arriving = spark.readStream.schema(fx.table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
    shaped = spark.sql(fx.SAMPLES, events=arriving).withColumn("ts", F.col("ts").cast("timestamp"))
    target, progress = new_path(spark, "sessions"), new_path(spark, "progress")
    incremental.store_stream(incremental.sample_sketch_roll_up(shaped, "6 hours", "1 hour"), target, progress).awaitTermination()
    closed = spark.read.schema(incremental.SKETCHED).parquet(target).withColumn("state", F.lit("closed"))
    open_ = incremental.open_sessions(spark, progress).withColumn("state", F.lit("open"))
    rolled = incremental.with_percentiles(closed.unionByName(open_))
    return rolled.withColumn("started", F.unix_micros("started")).withColumn("closed", F.unix_micros("closed"))


STREAM_DELAY, STREAM_LONGEST = "65 days 12 hours", "65 days"


#: Rows in a file of an arriving share; a share of more comes in more files.
ARRIVING_ROWS = 1_000_000


def _arriving(rows: DataFrame, shares: list[float], path: str) -> DataFrame:
    """A stream of the rows by time, one share after the other, which end at the given shares of the rows.

    Every share has the same number of files, which arrive together.
    """
    spark = rows.sparkSession
    seconds = F.unix_seconds("end_time")
    ends, total = rows.agg(F.percentile_approx(seconds, shares, 10_000), F.count("*")).first()
    files = max(1, -(-total // ARRIVING_ROWS))
    written = 0
    for start, end in zip([None, *ends], [*ends, None], strict=True):
        after = F.lit(True) if start is None else seconds > start
        upto = F.lit(True) if end is None else seconds <= end
        share = rows.filter(after & upto)
        with shuffles_removed(spark):
            (share.coalesce(1) if files == 1 else share.repartition(files)).write.mode("append").parquet(path, compression="zstd")
        written += files
        # Partitions without rows leave no file.
        for _ in range(written - compaction.files_below(spark, path, "part-*").count()):
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def stream_joined_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and app builds arrive in files, so that builds come before, with and after their runs."""
    time = F.col("end_time").cast("timestamp")
    runs = fx.timed_runs(spark, sf_dir).withColumn("end_time", time)
    built = fx.app_builds(spark, sf_dir).select("app_build_id", "framework_build_id", "app_name", "apps_commit", time.alias("end_time"))
    streams = []
    for rows, shares in ((runs, [0.25, 0.5, 0.75]), (built, [0.1, 0.75])):
        ordered = new_path(spark, "arriving")
        streams.append(_arriving(settle(rows, "arriving", ordered), shares, new_path(spark, "arrivals")))
        delete(spark, ordered)
    target = new_path(spark, "joined")
    joined = incremental.join_streams(*streams, STREAM_DELAY, STREAM_LONGEST)
    # The state is mostly ids in hexadecimal text, which zstd halves.
    incremental.store_stream(joined, target, new_path(spark, "progress"), "zstd").awaitTermination()
    return spark.read.schema(joined.schema).parquet(target).select("test_run_id", "app_build_id", "app_name", "state")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        report_results, report_window_results, runs_joined, runs_joined_bucketed, latest_runs_bucketed,
        ledger_pruned, dangling_runs, parse_outputs, parse_variant, output_schema, parse_status_counts,
        percentile_lookup, measured_execution, error_gate, error_messages, derived_metrics, overwritten_results,
        execution_durations, build_success, build_tallies, app_build_tallies, failure_budget, latest_builds,
        commit_log_source, first_parent_log, first_parent_range, range_reachability, log_to_date, chain_index_append,
        chain_index_to_date, chain_index_sample, commit_sample, commit_sample_monotone,
        resolve_revisions, reported_commits, branch_series, missing_branches, matrix_explode, matrix_checks,
        matrix_branches, filter_matrix, unresolved_lines, needed_tasks, tasks_to_run, coverage_counts, plan_order_date,
        plan_order_lexical, plan_top_n, budgeted_plan, rebuild_points, rebuild_decision, skip_reasons,
        render_commands, effective_duration, report_lines, report_text, report_text_values, report_json_per_commit,
        report_json_values, report_js, report_js_values, sample_totals, sample_stats, sample_percentiles,
        sample_percentiles_approx, sketch_windows, coverage_sketched, warmup_excluded, version_extract, cap_output, ingest_records,
        compacted_records,
        ingest_quarantine, repeated_ids, ledger_upsert, stream_ingest, stream_latest_results, stream_sample_rollup,
        stream_open_sessions, stream_joined_results,
    )
}
