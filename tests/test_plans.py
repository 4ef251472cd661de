import dataclasses
import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from benchledger import fixtures as fx
from benchledger import queries
from benchledger.operators import builds
from benchledger.plans import commands as cmd
from benchledger.plans import report, results, tasks
from benchledger.session import new_path
from benchledger.sources import records

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return queries._tables(spark, SF)


@pytest.fixture(scope="module")
def planned(tables):
    return cmd.planned_commits(tables)


def key(row):
    return row.test_name, row.framework_commit, row.app_name


def test_needed_is_to_run_and_completed(tables, planned):
    needed = cmd.needed(tables, planned=planned).collect()
    to_run = cmd.to_run(tables, planned=planned).collect()
    done = {key(r) for r in tasks.completed_keys(tables.test_runs, tables.app_builds, tables.framework_builds).collect()}
    assert sorted(map(key, to_run)) == sorted(key(r) for r in needed if key(r) not in done)
    assert 0 < len(to_run) < len(needed)
    repeated = cmd.to_run(tables, tasks.PlanOptions(repeat_tests=True), planned)
    assert repeated.count() == len(needed)


def test_plan_from_record_files(spark, tables, planned):
    """The commands run on tables decoded from record files, and find the same open tasks."""
    home = new_path(spark, "home")
    for name, folder in fx.LAYOUT.directories.items():
        fx.write_archive(spark, SF, name, f"{home}/{folder}")
    stored = records.load_tables(spark, home, fx.LAYOUT, archive=True, strict=True)
    assert stored.pop("quarantine").count() == 0
    ranges = planned.ranges.withColumn("instance_id", fx.instance_uuid(F.col("instance_id")))
    from_files = cmd.Tables(**{**vars(tables), **stored})
    plan = cmd.plan(from_files, planned=cmd.PlannedCommits(ranges, planned.commits))
    expected = cmd.plan(tables, planned=planned)
    columns = ["seq", *tasks.TASK_KEY, "apps_commit", "is_current"]
    assert sorted(map(tuple, plan.select(columns).collect())) == sorted(map(tuple, expected.select(columns).collect()))
    assert expected.filter("is_current").count() > 0 or plan.filter("is_current").count() == 0


def test_what_does_not_resolve_is_an_error_or_listed(tables, planned):
    """A matrix line and a wanted revision that stand for nothing."""
    line = tables.matrix.limit(1).withColumns({"config_id": F.lit(99), "revision_range": F.lit("zzz..HEAD")})
    vague = dataclasses.replace(tables, matrix=tables.matrix.unionByName(line))
    with pytest.raises(cmd.Unresolved, match="zzz"):
        cmd.planned_commits(vague)
    kept = cmd.planned_commits(vague, tasks.PlanOptions(skip_unresolved=True))
    assert kept.ranges.count() == planned.ranges.count()
    with pytest.raises(cmd.Unresolved, match="nothing"):
        cmd.plan(tables, tasks.PlanOptions(revisions=["nothing"]), planned)
    with pytest.raises(cmd.Unresolved, match="gone"):
        cmd.branch_commits(tables, ["gone"], dt.datetime(2000, 1, 1))


def test_completed_options(tables, planned):
    """Runs without a valid result, or of another instance, may be left out of what is done."""
    sizes = [
        cmd.to_run(tables, tasks.PlanOptions(**options), planned).count()
        for options in ({}, {"successful_only": True}, {"same_instance": True}, {"repeat_tests": True})
    ]
    assert sizes[0] < sizes[1] <= sizes[3] and sizes[0] < sizes[2] <= sizes[3]


def test_window_results_decode_only_what_is_shown(spark, tables):
    shown = tables.commit_log.filter("branch = 'b1'")
    found = results.windowed_results(tables.test_runs, tables.app_builds, tables.framework_builds, shown, 7)
    whole = results.current_results(results.valid_results(tables.test_runs, tables.app_builds, tables.framework_builds))
    wanted = whole.filter("instance_id = 7").join(shown, F.col("commit_id") == F.col("framework_commit"), "left_semi")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.select(found.columns).collect()))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("from_json") < plan.index("LeftSemi")


def test_options_filter_and_limit(tables, planned):
    commit = planned.commits.filter("branch = 'b4'").orderBy("pos").first().commit_id
    options = tasks.PlanOptions(
        branches=["b4"], revisions=[commit[:9]], test_names=["A-F", "R-O"], repeat_tests=True, max_test_runs=1
    )
    rows = cmd.plan(tables, options, planned).collect()
    assert [(r.branch, r.framework_commit, r.seq) for r in rows] == [("b4", commit, 1)]
    assert rows[0].test_name in ("A-F", "R-O")


def test_order_is_current_first_then_newest(tables, planned):
    rows = cmd.plan(tables, planned=planned).collect()
    for instance in {r.instance_id for r in rows}:
        mine = sorted((r for r in rows if r.instance_id == instance), key=lambda r: r.seq)
        assert [r.seq for r in mine] == list(range(1, len(mine) + 1))
        marks = [(not r.is_current, -r.commit_time.timestamp()) for r in mine]
        assert marks == sorted(marks)


def test_budget_lets_the_last_task_run_over(spark):
    todo = spark.createDataFrame(
        [(1, f"t{i}", "c", "app", dt.datetime(2020, 1, 1), "b", "ab", "ac", False) for i in range(3)],
        "instance_id int, test_name string, framework_commit string, app_name string, commit_time timestamp, "
        "branch string, apps_branch string, apps_commit string, is_current boolean",
    )
    costs = spark.createDataFrame([(f"t{i}", 10) for i in range(3)], "test_name string, cost_seconds bigint")
    assert sorted(r.test_name for r in tasks.budgeted_plan(todo, costs, 15).collect()) == ["t0", "t1"]
    assert tasks.budgeted_plan(todo, costs, 20).count() == 3


def test_rebuild_points(spark):
    steps = [("c1", "x", "a1"), ("c1", "y", "a1"), ("c2", "x", "a1"), ("c1", "y", "a1"), ("c1", "y", "a2"), ("c1", "x", "a2"), ("c1", "x", "a2")]
    plan = spark.createDataFrame(
        [(1, i + 1, *s) for i, s in enumerate(steps)],
        "instance_id int, seq bigint, framework_commit string, app_name string, apps_commit string",
    )
    found = {r.seq: (r.framework_rebuild, r.app_rebuild) for r in tasks.rebuild_points(plan).collect()}
    assert [found[i] for i in range(1, 8)] == [
        (True, True), (False, True), (True, True), (True, True), (False, True), (False, True), (False, False),
    ]


def test_failure_budget_and_skip_ladder(spark):
    tallies = spark.createDataFrame([("c1", 1, 3), ("c2", 1, 2)], "framework_commit string, successes int, failures int")
    assert [r.framework_commit for r in tallies.filter(builds.over_budget(2)).collect()] == ["c1"]
    rows = [
        ("c1", "a", "build", "build", True, True, "too many framework build failures"),
        ("c1", "a", "reuse", "reuse", False, False, "framework build failed"),
        ("c2", "a", "build", "build", None, None, "too many app build failures"),
        ("c2", "b", "reuse", "reuse", True, False, "app build failed"),
        ("c2", "b", "build", "build", None, None, None),
    ]
    decisions = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i int, framework_commit string, apps_commit string, framework_action string, app_action string, "
        "last_framework_ok boolean, last_app_ok boolean, expected string",
    )
    apps = spark.createDataFrame([("a", "c2", 0, 2)], "apps_commit string, framework_commit string, successes int, failures int")
    found = tasks.skip_reasons(decisions, tallies, apps).collect()
    assert len(found) == len(rows)
    assert all(r.skip_reason == r.expected for r in found)


def test_report_text(tables, planned):
    lines = cmd.print_report(tables, tasks.PlanOptions(branches=["b4"], test_names=["A-F"]), planned).orderBy("pos").collect()
    commits = planned.commits.filter("config_id = 4").orderBy("pos").collect()
    assert lines[0].line == f"=== Test A-F on b4 - {len(commits)} commits ==="
    assert [r.line[:8] for r in lines[1:]] == [c.commit_id[:7] + " " for c in commits]
    assert any(r.line.endswith(report.NO_RESULT) for r in lines)


def test_document_is_the_nested_report(spark, tables):
    as_of, length = dt.datetime(2001, 8, 1, 12, 30), dt.timedelta(days=1200)
    branches = [f"b{i}" for i in range(9)]
    lines = cmd.json_report(tables, 7, branches, as_of, length, as_script=True)
    path = new_path(spark, "report")
    report.write_lines(lines, ["section", "name", "ordinal"], path)
    text = "".join(p.read_text() for p in sorted(Path(path).glob("part-*")))
    assert text.startswith("var report = {") and text.rstrip().endswith("};")
    document = json.loads(text.removeprefix("var report = ").rstrip().removesuffix(";"))

    start = as_of - length
    assert document["start"] == int(start.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert document["tests"] == {r.test_name: r.description for r in fx.tests(spark).collect()}
    shown = cmd.branch_commits(tables, branches, start).orderBy("branch", "pos").collect()
    assert sorted(document["branches"]) == branches
    for branch, listed in document["branches"].items():
        expected = [r for r in shown if r.branch == branch]
        assert [c["commit"] for c in listed] == [r.commit_id for r in expected]
        assert listed[0]["time"] == int(expected[0].commit_time.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    results = queries.report_results(spark, SF).filter(F.col("instance_id") == 7).collect()
    commits = {r.commit_id for r in shown}
    wanted = {}
    for r in results:
        if r.framework_commit in commits:
            wanted.setdefault(r.framework_commit, {})[r.test_name] = {
                "run": r.test_run_id, "req/s": r.requests_per_second, "latMean": r.latency_mean_ms, "lat95": r.latency_p95_ms,
            }
    assert document["results"] == wanted and wanted


def test_empty_report_is_valid_json(spark, tables):
    nothing = queries.report_results(spark, SF).filter("false")
    no_commits = cmd.branch_commits(tables, [], dt.datetime(2000, 1, 1)).filter("false")
    lines = report.report_document(no_commits, fx.tests(spark).filter("false"), nothing, dt.datetime(2000, 1, 1), dt.datetime(2001, 1, 1))
    text = "".join(r.line for r in lines.orderBy("section", "name", "ordinal").collect())
    document = json.loads(text)
    assert (document["branches"], document["tests"], document["results"]) == ({}, {}, {})
