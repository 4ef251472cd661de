import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from benchledger import fixtures as fx
from benchledger import queries
from benchledger.schemas import RecordLayout
from benchledger.session import new_path
from benchledger.sources import matrix, records
from benchledger.streaming import incremental

SF = "/root/testdata/sf0.001"
LAYOUT = RecordLayout(tool="bench", framework="web")


def execution(end=1456827630000, code=0, stdout=None):
    return {
        "command": {"program": "p", "args": ["a"], "workingDir": "/w", "env": {"K": "V"}},
        "startTime": end - 1000,
        "endTime": end,
        "stdout": stdout,
        "stderr": None,
        "returnCode": code,
    }


def build_record(codes=(0,)):
    return {
        "benchInstanceId": str(uuid.uuid4()),
        "webCommit": "c1",
        "javaVersionExecution": execution(),
        "buildExecutions": [execution(code=c) for c in codes],
    }


def write(folder, name, record):
    folder.mkdir(parents=True, exist_ok=True)
    content = record if isinstance(record, str) else json.dumps(record, indent=2)
    (folder / f"{name}.json").write_text(content)


def test_one_file_per_record(spark, tmp_path):
    ids = [str(uuid.uuid4()) for _ in range(3)]
    write(tmp_path / "web-builds", ids[0], build_record())
    write(tmp_path / "web-builds" / "nested", ids[1], build_record((0, 1)))
    write(tmp_path / "web-builds", ids[2], build_record(()))
    (tmp_path / "web-builds" / "notes.txt").write_text("not a record")
    tables = records.load_tables(spark, str(tmp_path), LAYOUT)
    found = {r.framework_build_id: r for r in tables["framework_builds"].collect()}
    assert {i: found[i].successful for i in ids} == dict(zip(ids, [True, False, True], strict=True))
    assert found[ids[0]].framework_commit == "c1"
    assert found[ids[0]].end_time.isoformat() == "2016-03-01T10:20:30"
    # The other two directories do not exist: no records.
    assert tables["app_builds"].count() == 0 and tables["test_runs"].count() == 0
    assert spark.table("framework_builds").count() == 3


def test_quarantine_names_the_problem(spark, tmp_path):
    folder = tmp_path / "web-builds"

    def broken(change):
        record = build_record()
        change(record)
        return record

    good = str(uuid.uuid4())
    cases = {
        str(uuid.uuid4()): ("{ not json", "malformed"),
        "not-a-uuid": (build_record(), "bad id"),
        str(uuid.uuid4()): (broken(lambda r: r.pop("webCommit")), "missing webCommit"),
        str(uuid.uuid4()): (broken(lambda r: r.update(benchInstanceId="x")), "bad benchInstanceId"),
        str(uuid.uuid4()): (broken(lambda r: r["buildExecutions"][0].pop("command")), "incomplete buildExecutions"),
        str(uuid.uuid4()): (broken(lambda r: r["javaVersionExecution"].update(endTime="soon")), "bad time in javaVersionExecution"),
        str(uuid.uuid4()): (broken(lambda r: r.update(buildExecutions="none")), "malformed"),
    }
    write(folder, good, build_record())
    for name, (record, _) in cases.items():
        write(folder, name, record)
    usable, bad = records.split_records(
        records.scan_records(spark, str(folder), "framework_builds", LAYOUT), "framework_builds", LAYOUT
    )
    assert [r.id for r in usable.collect()] == [good]
    assert {r.id: r.reason for r in bad.collect()} == {name: reason for name, (_, reason) in cases.items()}


def test_ledger_replaces_by_id_and_survives_a_repeat(spark):
    path = new_path(spark, "ledger")
    schema = "id string, value int"
    for batch_id, rows in ((0, [("a", 1), ("b", 1)]), (1, [("b", 2)]), (1, [("b", 3), ("c", 3)])):
        records.append_batch(spark.createDataFrame(rows, schema), path, batch_id)
    found = {r.id: r.value for r in records.read_ledger(spark, path, schema, "id").collect()}
    assert found == {"a": 1, "b": 3, "c": 3}


def test_matrix_files(spark, tmp_path):
    lines = [
        {"config_id": 1, "instance_id": "i1", "branch": "main", "revision_range": "a..HEAD", "sampling": 0.5,
         "apps_branch": "apps", "apps_revision": "HEAD", "test_names": ["t1", "t1", "t9"]},
        {"config_id": 2, "instance_id": "i1", "branch": "old", "revision_range": "a", "sampling": 1.5,
         "apps_branch": "apps", "apps_revision": "HEAD", "test_names": []},
    ]
    tests = [
        {"test_name": n, "app_name": "app", "description": "d", "wrk_args": []} for n in ("t1", "t2", "t2")
    ]
    (tmp_path / "matrix.json").write_text(json.dumps(lines))
    (tmp_path / "tests.json").write_text(json.dumps(tests))
    read_lines = matrix.read_matrix(spark, str(tmp_path / "matrix.json"))
    read_tests = matrix.read_tests(spark, str(tmp_path / "tests.json"))
    report_branches = spark.createDataFrame([("main",), ("next",)], "branch string")
    found = {tuple(r) for r in matrix.violations(read_lines, read_tests, report_branches).collect()}
    assert found == {
        ("sampling out of range", "2", 1),
        ("range without two parts", "2", 1),
        ("unknown test", "t9", 1),
        ("unscheduled test", "t2", 2),
        ("duplicate test", "t2", 2),
        ("report branch not in matrix", "next", 1),
    }
    valid = matrix.valid_lines(read_lines).collect()
    assert [(r.start_revision, r.end_revision) for r in valid] == [("a", "HEAD")]
    assert {tuple(r) for r in matrix.distinct_branches(read_lines).collect()} == {
        ("framework", "main"), ("framework", "old"), ("apps", "apps"),
    }


@pytest.mark.parametrize("files,per_batch", [(1, 1), (5, 1), (7, 3)])
def test_any_split_into_batches_gives_the_batch_result(spark, files, per_batch):
    arrivals, state = new_path(spark, "arrivals"), new_path(spark, "state")
    runs = fx.test_runs(spark, SF).withColumn("_part", F.pmod(F.xxhash64("test_run_id"), F.lit(files)))
    runs.repartition(files, "_part").drop("_part").write.parquet(arrivals)
    stream = spark.readStream.schema(
        "test_run_id string, app_build_id string, test_name string, end_time timestamp_ntz, stdout string"
    ).option("maxFilesPerTrigger", per_batch).parquet(arrivals)
    incremental.keep_latest_results(
        stream.withColumn("end_time", F.col("end_time").cast("timestamp")), state, new_path(spark, "progress")
    ).awaitTermination()
    builds = fx.app_builds(spark, SF), fx.framework_builds(spark, SF)
    expected = queries.report_results(spark, SF)
    columns = sorted(expected.columns)
    wanted = sorted(map(tuple, expected.select(columns).collect()))
    latest = incremental.read_latest_results(spark, state, *builds)
    assert sorted(map(tuple, latest.select(columns).collect())) == wanted
    if files == 7:
        compacted = new_path(spark, "compacted")
        incremental.compact_results(spark, state, compacted)
        again = incremental.read_latest_results(spark, compacted, *builds)
        assert sorted(map(tuple, again.select(columns).collect())) == wanted


def test_stream_reads_single_record_files_once(spark, tmp_path):
    ledger, progress = new_path(spark, "ledger"), new_path(spark, "progress")
    folder = tmp_path / "web-builds"
    ids = [str(uuid.UUID(int=random.getrandbits(128))) for _ in range(4)]
    for i in ids[:3]:
        write(folder, i, build_record())

    def ingest():
        stream = incremental.stream_records(spark, str(folder), "framework_builds", LAYOUT, max_files=2)
        incremental.ingest(stream, "framework_builds", ledger, progress, LAYOUT).awaitTermination()
        stored = spark.read.schema("framework_build_id string, successful boolean").parquet(ledger)
        return sorted(r.framework_build_id for r in stored.collect())

    assert ingest() == sorted(ids[:3])
    write(folder, ids[3], build_record())
    write(folder, "broken", "{")
    assert ingest() == sorted(ids)
    bad = records.read_batches(spark, f"{ledger}-quarantine", records.QUARANTINE_SCHEMA).collect()
    assert [(row.id, row.reason) for row in bad] == [("broken", "malformed")]


def test_a_ledger_before_its_first_batch_is_empty(spark):
    assert records.read_ledger(spark, new_path(spark, "none"), "id string, value int", "id").count() == 0
    builds = fx.app_builds(spark, SF), fx.framework_builds(spark, SF)
    assert incremental.read_latest_results(spark, new_path(spark, "none"), *builds).count() == 0


def test_a_ledger_by_instance_and_date_skips_directories(spark):
    path, schema = new_path(spark, "ledger"), "id string, value int, instance string, day string"
    rows = spark.createDataFrame([("a", 1, "i1", "d1"), ("b", 2, "i2", "d1"), ("c", 3, "i1", "d2")], schema)
    records.append_batch(rows, path, 0, ["instance", "day"])
    found = records.read_ledger(spark, path, schema, "id", F.col("instance") == "i1")
    assert sorted(row.id for row in found.collect()) == ["a", "c"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(instance" in plan


def test_strict_load_names_the_damage(spark, tmp_path):
    write(tmp_path / "web-builds", str(uuid.uuid4()), build_record())
    write(tmp_path / "web-builds", "broken", "{")
    assert [r.reason for r in records.load_tables(spark, str(tmp_path), LAYOUT)["quarantine"].collect()] == ["malformed"]
    with pytest.raises(records.DamagedRecords, match="broken: malformed"):
        records.load_tables(spark, str(tmp_path), LAYOUT, strict=True)


def test_late_samples_are_counted(spark):
    closed = spark.createDataFrame([(1, "2020-01-01 00:00:00", "2020-01-01 01:00:00", 2)], "run_key bigint, started string, closed string, requests bigint")
    whole = spark.createDataFrame([], incremental.ROLLED_UP)
    closed = whole.unionByName(
        closed.withColumns({c: F.col(c).cast("timestamp") for c in ("started", "closed")}), allowMissingColumns=True
    )
    samples = spark.createDataFrame(
        [(1, "2020-01-01 00:00:00", 5, "ok")] * 3 + [(1, "2020-01-02 00:00:00", 7, "ok"), (2, "2020-01-01 00:00:00", 9, "error")],
        "run_key bigint, ts string, latency_us bigint, outcome string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    rows = incremental.with_open_sessions(closed, samples, "6 hours").collect()
    assert sorted((r.run_key, r.state, r.requests) for r in rows) == [(1, "closed", 2), (1, "late", 1), (1, "open", 1), (2, "open", 1)]
