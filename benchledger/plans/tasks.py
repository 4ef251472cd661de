"""Which tests still have to run, in which order, and what each of them needs first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchledger.functions import commands
from benchledger.operators import builds as build_ops
from benchledger.operators import commits as commit_ops
from benchledger.operators.ledger import join_builds, join_runs, likely
from benchledger.operators.ordering import number_rows, prefix_sums, with_previous
from benchledger.session import settle
from benchledger.sources import matrix as matrix_ops

TASK_KEY = ["test_name", "framework_commit", "app_name"]

# Seconds of the warm-up and of the measured run of a test.
WARM_UP_SECONDS = 30
TEST_SECONDS = 120


@dataclass(frozen=True)
class PlanOptions:
    """Options of the planning command; an empty list does not filter."""

    branches: Sequence[str] = ()
    revisions: Sequence[str] = ()
    test_names: Sequence[str] = ()
    lexical_order: bool = False
    repeat_tests: bool = False
    # Count a run as done only on the task's own instance, and only if it has a valid result.
    same_instance: bool = False
    successful_only: bool = False
    # Leave out what does not resolve, instead of stopping; ``unresolved_lines`` lists it.
    skip_unresolved: bool = False
    max_test_runs: int | None = None
    max_total_seconds: int | None = None
    max_build_failures: int = build_ops.MAX_BUILD_FAILURES
    max_load_seconds: int | None = None


def line_resolutions(
    matrix: DataFrame, commit_log: DataFrame, refs: DataFrame, apps_log: DataFrame, apps_refs: DataFrame
) -> DataFrame:
    """Every valid matrix line with what its three revisions stand for.

    Adds ``start_id``, ``walk_id`` (the end) and
    ``apps_commit``, each with how it resolved in ``start_resolution``, ``end_resolution`` and
    ``apps_resolution``.
    """
    lines = matrix_ops.valid_lines(matrix)
    wanted = lines.select("branch", F.col("start_revision").alias("revision")).union(
        lines.select("branch", "end_revision")
    )
    found = settle(commit_ops.resolve_revisions(wanted.distinct(), commit_log, refs), "resolved")
    apps_wanted = lines.select(F.col("apps_branch").alias("branch"), F.col("apps_revision").alias("revision"))
    apps = commit_ops.resolve_revisions(apps_wanted.distinct(), apps_log, apps_refs)

    def named(rows: DataFrame, branch: str, role: str, id_name: str) -> DataFrame:
        return rows.select(
            F.col("branch").alias(branch),
            F.col("revision").alias(f"{role}_revision"),
            F.col("resolved_id").alias(id_name),
            F.col("resolution").alias(f"{role}_resolution"),
        )

    return (
        lines.join(named(found, "branch", "start", "start_id"), ["branch", "start_revision"], "left")
        .join(named(found, "branch", "end", "walk_id"), ["branch", "end_revision"], "left")
        .join(named(apps, "apps_branch", "apps", "apps_commit"), ["apps_branch", "apps_revision"], "left")
    )


def resolved_lines(resolutions: DataFrame) -> DataFrame:
    """The lines whose revisions all resolved; the others are in ``unresolved_lines``."""
    roles = ("start", "end", "apps")
    good = reduce(Column.__and__, [F.col(f"{role}_resolution") == "resolved" for role in roles])
    return resolutions.filter(good).drop(*[f"{role}_resolution" for role in roles])


def unresolved_lines(resolutions: DataFrame) -> DataFrame:
    """(config_id, branch, role, revision, resolution): the revisions that stand for no commit, or several."""
    roles = {"start": "branch", "end": "branch", "apps": "apps_branch"}
    each = F.array(
        *[
            F.struct(
                F.col(branch).alias("branch"),
                F.lit(role).alias("role"),
                F.col(f"{role}_revision").alias("revision"),
                F.col(f"{role}_resolution").alias("resolution"),
            )
            for role, branch in roles.items()
        ]
    )
    return (
        resolutions.select("config_id", F.explode(each).alias("_one"))
        .select("config_id", "_one.*")
        .filter(F.col("resolution") != "resolved")
    )


def planned_commits(
    ranges: DataFrame, blocks: commit_ops.CommitBlocks, chain: DataFrame
) -> DataFrame:
    """Sampled commits of every matrix line: (config_id, branch, commit_id, commit_time, pos)."""
    asked = ranges.select(F.col("config_id").alias("range_id"), "chain_id", "end_pos", "branch", "start_id")
    log = commit_ops.first_parent_range(blocks, chain, asked).withColumnRenamed("range_id", "config_id")
    return commit_ops.sample_log(log, ranges, "config_id")


def needed_tasks(
    ranges: DataFrame,
    commits: DataFrame,
    tests: DataFrame,
    options: PlanOptions = PlanOptions(),
    wanted_commits: DataFrame | None = None,
) -> DataFrame:
    """Distinct tasks of all matrix lines: each line's commits times its tests.

    ``wanted_commits`` (branch, commit_id) narrows the commits when ``options.revisions`` is set.
    """
    lines = matrix_ops.keep_members(ranges, "branch", options.branches)
    if wanted_commits is not None:
        commits = commits.join(wanted_commits, ["branch", "commit_id"], "left_semi")
    # Lines meet tests first: that side stays as small as the matrix. The explosion over tests then
    # happens inside the join with the commits.
    per_test = matrix_ops.explode_tests(
        lines.select("config_id", "instance_id", "apps_branch", "apps_commit", "test_names"),
        tests,
        options.test_names,
    )
    return (
        commits.join(per_test, "config_id")
        .select(
            "instance_id",
            "test_name",
            F.col("commit_id").alias("framework_commit"),
            "app_name",
            "commit_time",
            "branch",
            "apps_branch",
            "apps_commit",
        )
        .distinct()
    )


def completed_keys(
    test_runs: DataFrame,
    app_builds: DataFrame,
    framework_builds: DataFrame,
    same_instance: bool = False,
) -> DataFrame:
    """Task keys with at least one run. Failed runs count, and runs of any instance."""
    keys = [*TASK_KEY, "instance_id"] if same_instance else TASK_KEY
    builds = join_builds(app_builds, framework_builds).select("app_build_id", *[k for k in keys if k != "test_name"])
    builds = settle(builds, "builds")
    runs = likely(test_runs.select("app_build_id", "test_name"), "app_build_id", builds)
    return runs.join(builds, "app_build_id").select(*keys).distinct()


def tasks_to_run(needed: DataFrame, completed: DataFrame, options: PlanOptions = PlanOptions()) -> DataFrame:
    if options.repeat_tests:
        return needed
    return needed.join(completed, [c for c in completed.columns], "left_anti")


def run_counts(test_runs: DataFrame, app_builds: DataFrame, framework_builds: DataFrame) -> DataFrame:
    """Runs per task key."""
    runs = test_runs.select("app_build_id", "test_name")
    return join_runs(runs, app_builds, framework_builds).groupBy(*TASK_KEY).agg(F.count("*").alias("runs"))


def coverage_counts(counted_runs: DataFrame, needed: DataFrame, to_run: DataFrame) -> DataFrame:
    """(task_set, commits, tasks) for finished runs, needed tasks and tasks to run.

    ``counted_runs`` has one row per task key with its number of ``runs``.
    """

    def counted(rows: DataFrame, name: str, tasks: Column) -> DataFrame:
        # Per commit first, so the distinct count needs no second copy of the rows.
        per_commit = rows.groupBy("framework_commit").agg(tasks.alias("tasks"))
        return per_commit.agg(
            F.lit(name).alias("task_set"),
            F.count("*").alias("commits"),
            F.coalesce(F.sum("tasks"), F.lit(0)).alias("tasks"),
        )

    return reduce(
        DataFrame.unionByName,
        [
            counted(counted_runs, "completed", F.sum("runs")),
            counted(needed, "needed", F.count("*")),
            counted(to_run, "to_run", F.count("*")),
        ],
    )


def priority(options: PlanOptions = PlanOptions()) -> list[Column]:
    """Total order of tasks: the commit that is built now first, then newest first or by commit id."""
    mode = F.col("framework_commit").asc() if options.lexical_order else F.col("commit_time").desc()
    ties = ["apps_commit", "framework_commit", "test_name", "app_name", "branch", "apps_branch"]
    return [F.col("is_current").desc(), mode, *[F.col(c).asc() for c in ties]]


def with_current(tasks: DataFrame, latest_framework: DataFrame) -> DataFrame:
    """Mark the tasks of the commit that their instance built last."""
    current = latest_framework.select(
        "instance_id", F.col("framework_commit").alias("_current")
    )
    return (
        tasks.join(current, "instance_id", "left")
        .withColumn("is_current", F.coalesce(F.col("framework_commit") == F.col("_current"), F.lit(False)))
        .drop("_current")
    )


def ordered_plan(tasks: DataFrame, options: PlanOptions = PlanOptions()) -> DataFrame:
    """Add ``seq``, the place of a task in its instance's work list.

    The tasks are written first: the range shuffle samples its input, which would otherwise run the
    whole plan a second time.
    """
    return number_rows(settle(tasks, "tasks"), priority(options), partition=["instance_id"])


def first_tasks(tasks: DataFrame, limit: int, options: PlanOptions = PlanOptions()) -> DataFrame:
    """The first ``limit`` tasks overall."""
    return tasks.orderBy(*priority(options), "instance_id").limit(limit)


def budgeted_plan(tasks: DataFrame, costs: DataFrame, budget_seconds: int, options: PlanOptions = PlanOptions()) -> DataFrame:
    """Tasks that start within the budget of their instance.

    The clock is read before each task, so the last one may run over. ``costs`` is (test_name,
    cost_seconds).
    """
    plan = ordered_plan(tasks.join(costs, "test_name"), options)
    started = prefix_sums(
        settle(plan, "plan"), {"starts_after_seconds": "cost_seconds"}, partition=["instance_id"]
    )
    return started.filter(F.col("starts_after_seconds") <= budget_seconds)


def expected_costs(tests: DataFrame, override_seconds: int | None = None) -> DataFrame:
    """Seconds a test takes: warm-up and measurement, each cut down to the override."""
    seconds = commands.effective_duration(F.lit(WARM_UP_SECONDS), override_seconds) + commands.effective_duration(
        F.lit(TEST_SECONDS), override_seconds
    )
    return tests.select("test_name", seconds.cast("bigint").alias("cost_seconds"))


def rebuild_points(plan: DataFrame) -> DataFrame:
    """Where a plan, run in order, has to build: consecutive tasks share a build.

    The framework is built when the commit changes. An app is built when the framework was built
    since the app's last task, or its own commit changed.
    """
    plan = settle(plan, "plan")
    steps = with_previous(
        plan.select("instance_id", "seq", "framework_commit", "app_name", "apps_commit"),
        ["framework_commit"],
        partition=["instance_id"],
    )
    changed = F.coalesce(F.col("framework_commit") != F.col("previous_framework_commit"), F.lit(True))
    flagged = settle(
        steps.withColumn("_built", changed.cast("bigint")).drop("previous_framework_commit"), "steps"
    )
    counted = prefix_sums(flagged, {"_before": "_built"}, partition=["instance_id"])
    numbered = counted.select(
        *[c for c in flagged.columns if c != "_built"],
        (F.col("_built") == 1).alias("framework_rebuild"),
        (F.col("_before") + F.col("_built")).alias("framework_build"),
    )
    # The tasks of one app under one framework build are distinct tests of the matrix: a short list.
    shared = Window.partitionBy("instance_id", "framework_build", "app_name").orderBy("seq")
    same_app = F.lag("apps_commit").over(shared) == F.col("apps_commit")
    return numbered.withColumn("app_rebuild", ~F.coalesce(same_app, F.lit(False)))


def rebuild_decisions(tasks: DataFrame, latest_framework: DataFrame, latest_apps: DataFrame) -> DataFrame:
    """For each task taken on its own: build or reuse the framework and the app, and why.

    A failed last build is still reused; ``skip_reasons`` then skips the task.
    """
    framework = latest_framework.select(
        "instance_id",
        F.col("framework_build_id").alias("last_framework_build"),
        F.col("framework_commit").alias("last_framework_commit"),
        F.col("successful").alias("last_framework_ok"),
        F.col("artefact_present").alias("repository_present"),
    )
    apps = latest_apps.select(
        "instance_id",
        "app_name",
        F.col("app_build_id").alias("last_app_build"),
        F.col("framework_build_id").alias("last_app_framework"),
        F.col("apps_commit").alias("last_apps_commit"),
        F.col("successful").alias("last_app_ok"),
        F.col("artefact_present").alias("binary_present"),
    )
    joined = tasks.join(framework, "instance_id", "left").join(apps, ["instance_id", "app_name"], "left")
    framework_reason = (
        F.when(F.col("last_framework_build").isNull(), "no current build")
        .when(F.col("last_framework_commit") != F.col("framework_commit"), "commit changed")
        .when(~F.col("repository_present"), "repository missing")
    )
    app_reason = (
        F.when(F.col("last_app_build").isNull(), "no current build")
        .when(
            F.col("framework_reason").isNotNull() | (F.col("last_app_framework") != F.col("last_framework_build")),
            "framework build changed",
        )
        .when(F.col("last_apps_commit") != F.col("apps_commit"), "apps commit changed")
        .when(~F.col("binary_present"), "binary missing")
    )
    decided = joined.withColumn("framework_reason", framework_reason).withColumn("app_reason", app_reason)
    return decided.select(
        *tasks.columns,
        F.when(F.col("framework_reason").isNull(), "reuse").otherwise("build").alias("framework_action"),
        "framework_reason",
        F.when(F.col("app_reason").isNull(), "reuse").otherwise("build").alias("app_action"),
        "app_reason",
        "last_framework_ok",
        "last_app_ok",
    )


def skip_reasons(
    decisions: DataFrame,
    framework_tallies: DataFrame,
    app_tallies: DataFrame,
    max_failures: int = build_ops.MAX_BUILD_FAILURES,
) -> DataFrame:
    """Why a task would be skipped, or null: the first obstacle from the framework to the app."""
    blocked_framework = framework_tallies.filter(build_ops.over_budget(max_failures)).select(
        "framework_commit", F.lit(True).alias("_framework_blocked")
    )
    blocked_apps = app_tallies.filter(build_ops.over_budget(max_failures)).select(
        "apps_commit", "framework_commit", F.lit(True).alias("_app_blocked")
    )
    joined = decisions.join(blocked_framework, "framework_commit", "left").join(
        blocked_apps, ["apps_commit", "framework_commit"], "left"
    )
    reason = (
        F.when((F.col("framework_action") == "build") & F.col("_framework_blocked"), "too many framework build failures")
        .when((F.col("framework_action") == "reuse") & ~F.col("last_framework_ok"), "framework build failed")
        .when((F.col("app_action") == "build") & F.col("_app_blocked"), "too many app build failures")
        .when((F.col("app_action") == "reuse") & ~F.col("last_app_ok"), "app build failed")
    )
    return joined.withColumn("skip_reason", reason).drop("_framework_blocked", "_app_blocked")


def rendered_commands(
    tasks: DataFrame,
    tests: DataFrame,
    placeholders: Mapping[str, str],
    working_dir: str,
    override_seconds: int | None = None,
) -> DataFrame:
    """Tasks with the load command of their measured run and its time limit."""
    seconds = commands.effective_duration(F.lit(TEST_SECONDS), override_seconds)
    raw = commands.load_command(F.col("wrk_args"), seconds, working_dir)
    return (
        tasks.join(tests.select("test_name", "wrk_args"), "test_name")
        .withColumn("command", commands.render_command(raw, placeholders))
        .withColumn("timeout_ms", commands.timeout_millis(seconds))
        .drop("wrk_args")
    )
