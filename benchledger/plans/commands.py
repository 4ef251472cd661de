"""The commands of the tool as functions over a set of tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchledger.functions import times
from benchledger.operators import builds, chain_index, commits
from benchledger.operators.chain_index import ChainIndex
from benchledger.plans import report, results, tasks
from benchledger.session import beside, settle
from benchledger.sources import matrix as matrix_ops

# Fixed value: how far back the JSON report goes.
REPORT_LENGTH = dt.timedelta(days=300)


@dataclass(frozen=True)
class Tables:
    """Everything the commands read; see the README for the columns."""

    framework_builds: DataFrame
    app_builds: DataFrame
    test_runs: DataFrame
    commit_log: DataFrame
    refs: DataFrame
    apps_log: DataFrame
    apps_refs: DataFrame
    matrix: DataFrame
    tests: DataFrame
    # If given, histories come out of it and the log is not walked.
    chain_index: ChainIndex | None = None


@dataclass(frozen=True)
class PlannedCommits:
    """Resolved matrix lines and the sampled commits of each, both written."""

    ranges: DataFrame
    commits: DataFrame


class Unresolved(ValueError):
    """Revisions that stand for no commit."""


def _stop_at(problems: DataFrame, what: str) -> None:
    first = problems.limit(5).collect()
    if first:
        raise Unresolved(f"{what}: " + "; ".join(str(row.asDict()) for row in first))


def planned_commits(tables: Tables, options: tasks.PlanOptions = tasks.PlanOptions()) -> PlannedCommits:
    """Resolve the matrix and walk the history. A revision that does not resolve is an error."""
    index = tables.chain_index

    def resolved() -> DataFrame:
        lines = tasks.line_resolutions(
            tables.matrix, tables.commit_log, tables.refs, tables.apps_log, tables.apps_refs
        )
        return settle(lines, "resolutions")

    blocks, lines = beside(index.blocks if index else lambda: commits.commit_blocks(tables.commit_log), resolved)
    if not options.skip_unresolved:
        _stop_at(tasks.unresolved_lines(lines), "Matrix lines that do not resolve")
    chain, ranges = commits.shared_chains(blocks, tasks.resolved_lines(lines), tables.refs, index.walk if index else None)
    return PlannedCommits(ranges, settle(tasks.planned_commits(ranges, blocks, chain), "planned"))


def wanted_commits(tables: Tables, options: tasks.PlanOptions) -> DataFrame | None:
    """Commits that the wanted revisions stand for on the branches of the matrix; none wanted: None.

    Each revision must resolve on one branch at least.
    """
    if not options.revisions:
        return None
    wanted = tables.matrix.select("branch").distinct().select(
        "branch", F.explode(F.array(*[F.lit(r) for r in options.revisions])).alias("revision")
    )
    resolved = settle(commits.resolve_revisions(wanted, tables.commit_log, tables.refs), "wanted")
    if not options.skip_unresolved:
        nowhere = resolved.groupBy("revision").agg(F.max("resolved_id").alias("found")).filter("found IS NULL")
        _stop_at(nowhere.select("revision"), "Wanted revisions that do not resolve")
    return resolved.filter(F.col("resolution") == "resolved").select(
        "branch", F.col("resolved_id").alias("commit_id")
    )


def needed(tables: Tables, options: tasks.PlanOptions = tasks.PlanOptions(), planned: PlannedCommits | None = None) -> DataFrame:
    planned = planned or planned_commits(tables, options)
    return tasks.needed_tasks(
        planned.ranges, planned.commits, tables.tests, options, wanted_commits(tables, options)
    )


def to_run(tables: Tables, options: tasks.PlanOptions = tasks.PlanOptions(), planned: PlannedCommits | None = None) -> DataFrame:
    """Needed tasks without a run, marked with the commit that their instance built last."""
    runs = tables.test_runs
    if options.successful_only:
        runs = results.run_outcomes(runs).filter(F.col("outcome") == "ok")
    # Runs of commits that are not planned complete nothing.
    planned = planned or planned_commits(tables, options)
    asked = planned.commits.select(F.col("commit_id").alias("framework_commit")).distinct()
    framework_builds = tables.framework_builds.join(asked, "framework_commit", "left_semi")
    completed = tasks.completed_keys(runs, tables.app_builds, framework_builds, options.same_instance)
    open_tasks = tasks.tasks_to_run(needed(tables, options, planned), completed, options)
    return tasks.with_current(open_tasks, builds.latest_framework_builds(tables.framework_builds))


def plan(tables: Tables, options: tasks.PlanOptions = tasks.PlanOptions(), planned: PlannedCommits | None = None) -> DataFrame:
    """The work list of every instance in order (``seq``), cut to the options' limits."""
    todo = to_run(tables, options, planned)
    if options.max_total_seconds is None:
        ordered = tasks.ordered_plan(todo, options)
    else:
        costs = tasks.expected_costs(tables.tests, options.max_load_seconds)
        ordered = tasks.budgeted_plan(todo, costs, options.max_total_seconds, options)
    return ordered if options.max_test_runs is None else ordered.filter(F.col("seq") <= options.max_test_runs)


def print_report(
    tables: Tables, options: tasks.PlanOptions = tasks.PlanOptions(), planned: PlannedCommits | None = None
) -> DataFrame:
    """Text lines of the report: (config_id, test_name, pos, line)."""
    planned = planned or planned_commits(tables, options)
    ranges = matrix_ops.keep_members(planned.ranges, "branch", options.branches)
    wanted = report.reported_instances(ranges, planned.commits)
    outcomes = results.last_outcomes(tables.test_runs, tables.app_builds, tables.framework_builds, wanted)
    rows = report.report_rows(ranges, planned.commits, tables.tests, outcomes, options.test_names)
    return report.report_lines(rows, ranges, planned.commits, tables.tests, options.test_names)


def branch_commits(tables: Tables, branches: Sequence[str], start: dt.datetime) -> DataFrame:
    """Commits of the given branches from their heads back to ``start``; no names stand for all branches.

    A named branch without a head is an error.
    """
    named = tables.refs.sparkSession.createDataFrame([(name,) for name in branches], "branch string")
    _stop_at(named.join(tables.refs, "branch", "left_anti"), "Branches without a head")
    walks = matrix_ops.keep_members(tables.refs, "branch", branches).select(
        F.col("head").alias("walk_id"), "branch", F.col("head").alias("commit_id")
    )
    if tables.chain_index:
        return settle(chain_index.stored_log(tables.chain_index, walks, start), "branch_commits")
    blocks = commits.commit_blocks(tables.commit_log)
    return settle(
        commits.log_to_date(settle(commits.first_parent_log(blocks, walks), "chain"), start), "branch_commits"
    )


def json_report(
    tables: Tables,
    instance_id: int | str,
    branches: Sequence[str],
    as_of: dt.datetime,
    length: dt.timedelta = REPORT_LENGTH,
    as_script: bool = False,
) -> DataFrame:
    """The JSON report of one instance as ordered lines; ``as_script`` wraps it for the results page."""
    start = times.window_start(as_of, length)
    shown = branch_commits(tables, branches, start)
    current = results.windowed_results(
        tables.test_runs, tables.app_builds, tables.framework_builds, shown, instance_id
    )
    compose = report.report_js if as_script else report.report_document
    return compose(shown, tables.tests, current, start, as_of)
