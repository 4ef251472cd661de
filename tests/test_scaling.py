"""What keeps work, memory and disk in proportion: texts are read once, outputs opened once per layout, shuffles go."""

import json
import time

from pyspark.sql import functions as F

from benchledger.functions import variant
from benchledger.schemas import RecordLayout
from benchledger.session import settle
from benchledger.sources import compaction, records
from benchledger.streaming import incremental

LAYOUT = RecordLayout()


def execution(end):
    command = {"program": "p", "args": [], "workingDir": ".", "env": {}}
    return {"command": command, "startTime": str(end - 1), "endTime": str(end), "stdout": "x", "stderr": None, "returnCode": 0}


def line(n, **changes):
    own = {"id": f"{n:08d}-0000-0000-0000-000000000000", "appBuildId": f"{n:08d}-1111-0000-0000-000000000000", "testName": "t"}
    made = {"javaVersionExecution": execution(n), "serverExecution": execution(n), "wrkExecutions": [execution(n)]}
    return json.dumps(own | made | changes)


def archive(folder, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.json").write_text("".join(f"{one}\n" for one in lines))


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {name for name in files.split("\n") if "/shuffle_" in name}


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    settle(spark.range(1000).repartition(5, "id"), "shuffled")
    records.append_batch(spark.range(1000).repartition(5, "id"), str(tmp_path / "ledger"), 0)
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left


def test_a_packing_is_written_in_batches(spark, tmp_path, monkeypatch):
    for n in range(4):
        archive(tmp_path / "runs", line(n), line(n + 10))
    monkeypatch.setattr(compaction, "BATCH_BYTES", 1)
    target = str(tmp_path / "packed")
    assert compaction.pack(spark, str(tmp_path / "runs"), target, archive=True, archive_bytes=1) == 4
    assert compaction.pack(spark, str(tmp_path / "runs"), target, archive=True, archive_bytes=1) == 0
    assert len(list((tmp_path / "packed" / "archives").glob("batch_id=*"))) == 4
    packed = compaction.scan_packed(spark, target, "test_runs", LAYOUT, archive=True)
    plain = records.scan_records(spark, str(tmp_path / "runs"), "test_runs", LAYOUT, archive=True)
    assert sorted(packed.collect(), key=str) == sorted(plain.collect(), key=str)


def test_loading_reads_the_files_once(spark, tmp_path):
    archive(tmp_path / "test-runs", line(1), line(2, testName=None), "{", line(3))
    tables = records.load_tables(spark, str(tmp_path), LAYOUT, archive=True)
    assert sorted(row.test_run_id[:8] for row in tables["test_runs"].collect()) == ["00000001", "00000003"]
    assert {(row.id and row.id[:8], row.reason, row._corrupt) for row in tables["quarantine"].collect()} == {
        ("00000002", "missing testName", None), (None, "malformed", "{"),
    }
    assert not [name for name in tables["quarantine"].inputFiles() if str(tmp_path) in name]


def test_a_micro_batch_is_parsed_once(spark, tmp_path, monkeypatch):
    archive(tmp_path / "runs", line(1), line(2, testName=None), line(3))
    sources = {}
    append = records.append_batch

    def noted(rows, ledger, batch_id):
        sources[ledger] = rows.inputFiles()
        append(rows, ledger, batch_id)

    monkeypatch.setattr(records, "append_batch", noted)
    ledger = str(tmp_path / "ledger")
    stream = incremental.stream_records(spark, str(tmp_path / "runs"), "test_runs", LAYOUT, archive=True)
    incremental.ingest(stream, "test_runs", ledger, str(tmp_path / "progress"), LAYOUT).awaitTermination()
    assert sources[ledger] and sources[ledger] == sources[f"{ledger}-quarantine"]
    assert not (tmp_path / "ledger-arrived").exists()
    schema = "test_run_id string, test_name string, stdout string"
    named = records.read_ledger(spark, ledger, schema, "test_run_id", columns=[F.col("stdout").isNotNull().alias("has")])
    assert sorted((row.test_run_id[:8], row.has) for row in named.collect()) == [("00000001", True), ("00000003", True)]
    assert [row.reason for row in records.read_batches(spark, f"{ledger}-quarantine", records.QUARANTINE_SCHEMA).collect()] == ["missing testName"]


def test_a_stream_names_the_codec_of_its_state(spark, tmp_path):
    spark.createDataFrame([(1,), (1,)], "n int").write.parquet(str(tmp_path / "rows"))
    before = spark.conf.get(incremental.STATE_CODEC)
    once = spark.readStream.schema("n int").parquet(str(tmp_path / "rows")).dropDuplicates(["n"])
    incremental.store_stream(once, str(tmp_path / "out"), str(tmp_path / "progress"), "zstd").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert '"spark.sql.streaming.stateStore.compression.codec":"zstd"' in (tmp_path / "progress" / "offsets" / "0").read_text()
    assert spark.conf.get(incremental.STATE_CODEC) == before


def test_outputs_are_opened_once_per_layout(spark):
    texts = ['{"a":1,"b: BIGINT":2}', '{"a: BIGINT, b":1.25}', '{"a":1.5,"b":[]}', '{"a":{"BIGINT":1,"x":null},"b":[2]}',
             '{"a":{"DOUBLE":1,"x":null},"b":["y"]}', "[1]", "7", "{", "{}"]
    rows = spark.createDataFrame([(f"x JSON: {text}",) for text in texts] + [(None,)], "stdout string")
    found = variant.output_fields(variant.with_variant(rows))
    assert {(row.path, row.kind): row.outputs for row in found.collect()} == {
        ("$.a", "number"): 2, ("$.b: BIGINT", "number"): 1, ("$.a: BIGINT, b", "number"): 1, ("$.b", "array"): 3,
        ("$.a", "object"): 2, ("$.a.BIGINT", "number"): 1, ("$.a.DOUBLE", "number"): 1, ("$.a.x", "null"): 2,
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    first = plan.rindex("ObjectHashAggregate")  # what stands lower comes earlier
    assert plan.rindex("map_entries") < first
    assert "percentile" not in plan  # the declared fields, which nobody reads here
