import random

import pytest
from pyspark.sql import functions as F

from benchledger import queries
from benchledger.operators import ledger, sketches
from benchledger.session import new_path
from benchledger.sources import layouts, records

SF = "/root/testdata/sf0.001"


def executed(df):
    """The plan after it ran, as text and as its leaves."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    return plan


def file_scans(plan):
    """File scans below a plan, also in the stages that it has run."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            found.append(node)
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
    return found


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def side_of(plan_text, table):
    """The lines of a plan from the scan of a table up to the join that reads it."""
    lines = plan_text.split("\n")
    at = next(i for i, line in enumerate(lines) if f"_{table}[" in line or f"_{table} " in line)
    up = []
    for line in reversed(lines[:at]):
        up.append(line)
        if "SortMergeJoin" in line:
            return "\n".join(up)
    raise AssertionError(plan_text)


def test_runs_are_not_shuffled(spark, no_broadcast):
    stored = queries._bucketed(spark, SF)
    joined = stored.joined_runs()
    side = side_of(executed(joined).toString(), "runs")
    assert "Exchange" not in side
    # Without the buckets it is.
    plain = ledger.join_runs(*[spark.read.parquet(f"{stored.path}/{name}") for name in ("runs", "app_builds", "framework_builds")])
    assert executed(plain).toString().count("Exchange") > executed(joined).toString().count("Exchange")
    assert "Exchange" not in executed(stored.latest_runs()).toString()


def test_more_runs_and_another_session(spark, no_broadcast):
    stored = layouts.BucketedLedger(spark, "more_runs", new_path(spark, "bucketed"), 4)
    runs = spark.createDataFrame([("r1", "a1", "t", 1), ("r2", "a2", "t", 2)], "test_run_id string, app_build_id string, test_name string, end_time int")
    apps = spark.createDataFrame([("a1", "f1", "x", "c1"), ("a2", "f2", "x", "c1")], "app_build_id string, framework_build_id string, app_name string, apps_commit string")
    frameworks = spark.createDataFrame([("f1", 1, "k1")], "framework_build_id string, instance_id int, framework_commit string")
    stored.store(runs, apps, frameworks)
    more = spark.createDataFrame([("r3", "a1", "t", 5), ("r4", "a3", "t", 2)], runs.schema)
    builds = spark.createDataFrame([("a3", "f1", "y", "c2")], apps.schema)
    stored.store(more, builds, frameworks.limit(0), mode="append")
    want = {("r1", "k1"), ("r3", "k1"), ("r4", "k1")}
    assert {(r.test_run_id, r.framework_commit) for r in stored.joined_runs().collect()} == want
    schemas = {}
    for table in ("runs", "app_builds", "framework_builds"):
        schemas[table] = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.table(table).schema)
        spark.sql(f"DROP TABLE more_runs_{table}")
    stored.open(schemas)
    assert {(r.test_run_id, r.framework_commit) for r in stored.joined_runs().collect()} == want
    assert "Exchange" not in side_of(executed(stored.joined_runs()).toString(), "runs")
    assert {(r.app_build_id, r.test_run_id) for r in stored.latest_runs().collect()} == {("a1", "r3"), ("a2", "r2"), ("a3", "r4")}


def test_folders_are_pruned_at_run_time(spark):
    path = queries._stored_results(spark, SF)
    windows = queries._report_windows(spark, SF)
    pruned = layouts.results_in(spark, path, queries.RESULT_COLUMNS, windows)
    plan = executed(pruned)
    assert "dynamicpruning" in plan.toString().lower()
    scan = next(s for s in file_scans(plan) if "batch_id" in s.toString())
    read = scan.metrics().apply("numFiles").value()
    everything = len(records.read_batches(spark, path, f"{queries.RESULT_COLUMNS}, instance_id int, quarter int").inputFiles())
    assert 0 < read < everything / 5
    want = {(row.instance_id, row.quarter) for row in windows.collect()}
    got = pruned.collect()
    assert got and {(row.instance_id, row.quarter) for row in got} <= want
    assert all((row.requests == -1) == (row.test_run_id[0] == "a") for row in got)


def test_a_window_table_without_rows_reads_nothing(spark):
    path = queries._stored_results(spark, SF)
    none = queries._report_windows(spark, SF).filter("quarter = 0")
    assert layouts.results_in(spark, path, queries.RESULT_COLUMNS, none).count() == 0


def test_merged_latency_sketches_keep_their_rank_error(spark):
    chance = random.Random(4)
    values = [int(chance.paretovariate(1.2) * 1000) for _ in range(30_000)]
    rows = spark.createDataFrame([(n % 2, f"2020-01-{1 + n % 20:02d} 00:00:00", v) for n, v in enumerate(values)], "run_key bigint, ts string, latency_us bigint")
    daily = sketches.daily_sketches(rows.withColumn("ts", F.col("ts").cast("timestamp")))
    levels = (1, 10, 50, 90, 99)
    got = sketches.percentiles(sketches.merged(daily, ["run_key"]), levels).collect()
    assert len(got) == 10
    for row in got:
        own = sorted(values[row.run_key :: 2])
        below, upto = sum(v < row.latency_us for v in own), sum(v <= row.latency_us for v in own)
        rank = -(-row.percentile * len(own) // 100)
        assert max(0, below + 1 - rank, rank - upto) <= sketches.RANK_ERROR * len(own)
        assert (row.requests, row.min_us, row.max_us, row.latency_sum_us) == (len(own), own[0], own[-1], sum(own))


def test_sliding_windows(spark):
    rows = spark.createDataFrame([("2020-01-15",), ("1969-12-31",)], "day string").withColumn("day", F.to_date("day"))
    starts = {}
    for row in sketches.sliding(rows, 30, 10).collect():
        assert 0 <= (row.day - row.window_start).days < 30 and row.window_start.toordinal() % 10 == 719163 % 10
        starts.setdefault(row.day, []).append(row.window_start)
    assert all(len(set(own)) == 3 for own in starts.values())


def test_sets_of_tasks_beyond_the_exact_size(spark):
    tasks = spark.range(120_000).select(F.lit("t").alias("test_name"), (F.col("id") % 500).cast("string").alias("framework_commit"), F.col("id").cast("string").alias("app_name"))
    key = ["test_name", "framework_commit", "app_name"]
    parts = [("needed", tasks.filter("app_name < 50000")), ("needed", tasks.filter("app_name >= 30000 and app_name < 90000")), ("completed", tasks.filter("app_name >= 60000"))]
    stored = None
    for name, rows in parts:
        one = sketches.task_sketches(rows, name, key)
        stored = one if stored is None else stored.unionByName(one)
    got = {row.task_set: row.tasks for row in sketches.coverage(stored).collect()}
    for name, want in (("needed", 90_000), ("completed", 60_000), ("covered", 30_000), ("to_run", 60_000)):
        assert abs(got[name] - want) <= 3 * sketches.SET_ERROR * 90_000


def test_no_tasks(spark):
    none = spark.createDataFrame([], "test_name string, framework_commit string, app_name string")
    both = sketches.task_sketches(none, "needed", none.columns).unionByName(sketches.task_sketches(none, "completed", none.columns))
    assert {row.tasks for row in sketches.coverage(both).collect()} == {0}
