import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from benchledger.functions import parse, variant
from benchledger.session import new_path
from benchledger.sources import compaction, records
from benchledger.streaming import incremental
from tests.test_records_streams import LAYOUT, build_record, execution, write


def rows_of(df):
    return sorted(map(str, df.collect()))


def listing(path):
    return sorted((str(p), p.stat().st_mtime_ns) for p in path.rglob("*") if p.is_file())


@pytest.fixture
def folder(tmp_path):
    ids = [str(uuid.uuid4()) for _ in range(12)]
    for i, record_id in enumerate(ids[:8]):
        write(tmp_path / "records" / f"f{i % 3}", record_id, build_record((0,) * (i % 3)))
    write(tmp_path / "records", ids[8], "{ not json")
    write(tmp_path / "records", "no-uuid", build_record())
    return tmp_path / "records", ids


def test_packed_files_equal_the_directory(spark, folder, tmp_path):
    path, ids = folder
    target = str(tmp_path / "packed")
    assert compaction.pack(spark, str(path), target, archive_bytes=2000) > 1
    names = ["id", "reason"]

    def both():
        scans = (
            records.scan_records(spark, str(path), "framework_builds", LAYOUT),
            compaction.scan_packed(spark, target, "framework_builds", LAYOUT),
        )
        for part in (0, 1):
            plain, packed = [records.split_records(scan, "framework_builds", LAYOUT)[part] for scan in scans]
            columns = names if part else plain.columns
            assert rows_of(plain.select(*columns)) == rows_of(packed.select(*columns))
        return scans[1].count()

    assert both() == 10
    # A repeated run finds nothing to do and touches nothing.
    before = listing(tmp_path / "packed")
    assert compaction.pack(spark, str(path), target) == 0 and listing(tmp_path / "packed") == before
    # New files make another batch; the packed ones are not opened again.
    write(path, ids[9], build_record((1,)))
    assert both_differ(spark, path, target) == 1
    assert compaction.pack(spark, str(path), target) == 1
    assert both() == 11
    assert compaction.manifest(spark, target).groupBy("batch_id").count().count() == 2


def both_differ(spark, path, target):
    plain = records.scan_records(spark, str(path), "framework_builds", LAYOUT).count()
    return plain - compaction.scan_packed(spark, target, "framework_builds", LAYOUT).count()


def test_a_failure_between_the_steps_leaves_nothing_to_see(spark, folder, tmp_path, monkeypatch):
    path, ids = folder
    target = str(tmp_path / "packed")
    compaction.pack(spark, str(path), target)
    write(path, ids[10], build_record())
    store = records.append_batch

    def fail(rows, ledger, batch_id):
        if ledger.endswith("manifest"):
            raise RuntimeError("lost")
        store(rows, ledger, batch_id)

    monkeypatch.setattr(records, "append_batch", fail)
    with pytest.raises(RuntimeError, match="lost"):
        compaction.pack(spark, str(path), target)
    assert len(list((tmp_path / "packed" / "archives").glob("batch_id=*"))) == 2
    assert compaction.scan_packed(spark, target, "framework_builds", LAYOUT).count() == 10
    monkeypatch.undo()
    write(path, ids[11], build_record())
    compaction.pack(spark, str(path), target)
    found = [row.id for row in compaction.scan_packed(spark, target, "framework_builds", LAYOUT).collect()]
    assert len(found) == len(set(found)) == 12 and {ids[10], ids[11]} <= set(found)


def test_line_archives(spark, tmp_path):
    home = tmp_path / "lines"
    home.mkdir()
    lines = [json.dumps(build_record() | {"id": str(uuid.uuid4())}) for _ in range(9)]
    for i in range(3):
        (home / f"part-{i}.json").write_text("\n".join([*lines[i::3], "", "{ damaged"]) + "\n")
    target = str(tmp_path / "packed")
    assert compaction.pack(spark, str(home), target, archive=True, archive_bytes=1) == 3
    packed = compaction.scan_packed(spark, target, "framework_builds", LAYOUT, archive=True)
    plain = records.scan_records(spark, str(home), "framework_builds", LAYOUT, archive=True)
    assert rows_of(packed.select(*plain.columns)) == rows_of(plain) and packed.count() == 12


def test_nothing_to_pack(spark, tmp_path):
    target = new_path(spark, "packed")
    assert compaction.pack(spark, str(tmp_path / "none"), target) == 0
    assert compaction.scan_packed(spark, target, "framework_builds", LAYOUT).count() == 0


@pytest.mark.parametrize("archive", [False, True])
def test_of_records_with_one_id_the_last_one_counts(spark, tmp_path, archive):
    one, other = str(uuid.uuid4()), str(uuid.uuid4())
    folder = tmp_path / "web-builds"
    versions = [(one, 1456827630000, "old"), (one, 1456827690000, "new"), (other, 1456827630000, "only")]
    made = []
    for record_id, end, commit in versions:
        record = build_record() | {"webCommit": commit, "buildExecutions": [execution(end)]}
        made.append((record_id, record))
    if archive:
        folder.mkdir()
        (folder / "a.json").write_text("\n".join(json.dumps({"id": i} | r) for i, r in [*made, *made]))
    else:
        for n, (record_id, record) in enumerate(made):
            write(folder / f"folder{2 - n}", record_id, record)
    tables = records.load_tables(spark, str(tmp_path), LAYOUT, archive=archive)
    found = {row.framework_build_id: row.framework_commit for row in tables["framework_builds"].collect()}
    assert found == {one: "new", other: "only"} and tables["framework_builds"].count() == 2


def test_the_text_of_unrepeated_records_is_not_shuffled(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.current_timestamp().alias("end_time"), F.lit("x").alias("stdout"))
    path = new_path(spark, "rows")
    rows.union(rows.limit(3)).write.parquet(path)
    unique = records.unique_records(spark.read.parquet(path), "k")
    assert unique.count() == 1000
    plan = unique._jdf.queryExecution().executedPlan().toString()
    kept = plan[: plan.index("HashAggregate")] if "HashAggregate" in plan else plan
    assert "LeftAnti" in kept and "SortMergeJoin" not in plan


def output(**more):
    body = {
        "summary": {"duration": 5, "requests": 7, "bytes": 9, "errors": {"connect": 0, "read": 0, "write": 0, "status": 0, "timeout": 0}},
        "latency": {"min": 1, "mean": 2.5, "max": 9, "stdev": 1.5, "percentile": [[50, 2], [95, 8]]},
        "requests": {"min": 1, "mean": 2.5, "max": 9, "stdev": 1.5, "percentile": [[50, 2], [95, 8]]},
    }
    return parse.MARKER + json.dumps(body | more)


def test_variant_keeps_what_no_schema_declares(spark):
    texts = [
        output(extra={"p999": 12, "tags": ["a"]}),
        output(extra={"p999": "12"}),
        output(extra=None),
        output(summary={"duration": "long"}),
        output() + "}",
        "no marker",
        None,
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, stdout string")
    read = variant.with_variant(rows)
    plain = parse.parse_output(rows)
    assert {r.n: r.parse_status for r in read.collect()} == {r.n: r.parse_status for r in plain.collect()}
    both = read.join(plain.select("n", F.col("output").alias("plain")), "n")
    assert both.filter(~F.col("declared").eqNullSafe(F.col("plain"))).count() == 0
    p999 = {r.n: r.p for r in read.select("n", variant.field(F.col("output"), "$.extra.p999", "bigint").alias("p")).collect()}
    assert p999[0] == 12 and p999[2] is None and p999[6] is None
    fields = {(r.path, r.kind): r.outputs for r in variant.output_fields(read).collect()}
    assert fields["$.extra.p999", "number"] == fields["$.extra.p999", "string"] == fields["$.extra.tags", "array"] == 1
    assert fields["$.extra", "object"] == 2 and fields["$.extra", "null"] == 1
    assert fields["$.summary", "object"] == 5 and fields["$.summary.duration", "string"] == 1


def test_open_sessions_are_read_from_the_state(spark, tmp_path):
    schema = "run_key bigint, ts timestamp, latency_us bigint, outcome string"
    minutes = lambda n: f"2020-01-01 {n // 60:02d}:{n % 60:02d}:00"

    def arrive(rows):
        made = spark.createDataFrame([(k, minutes(m), v, o) for k, m, v, o in rows], "run_key bigint, ts string, latency_us bigint, outcome string")
        made.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        rolled = incremental.sample_sketch_roll_up(stream, "10 minutes", "5 minutes")
        query = incremental.store_stream(rolled, str(tmp_path / "out"), str(tmp_path / "progress"))
        query.awaitTermination()
        return query

    arrive([(1, 0, 10, "ok"), (1, 5, 30, "status"), (2, 3, 7, "ok")])
    open_ = incremental.with_percentiles(incremental.open_sessions(spark, str(tmp_path / "progress"))).collect()
    assert {(r.run_key, r.requests, r.latency_sum_us, r.status_errors, r.p50_us) for r in open_} == {(1, 2, 40, 1, 10), (2, 1, 7, 0, 7)}
    # Run 1 goes on before its session ends, run 2 ends, and a sample of run 2 comes too late.
    arrive([(1, 14, 50, "ok"), (3, 40, 1, "ok")])
    query = arrive([(2, 4, 9, "ok"), (3, 41, 2, "ok")])
    assert incremental.late_samples(query) == 1
    os.sync()
    closed = incremental.with_percentiles(spark.read.schema(incremental.SKETCHED).parquet(str(tmp_path / "out"))).collect()
    assert {(r.run_key, r.requests, r.p50_us, r.max_us) for r in closed} == {(1, 3, 30, 50), (2, 1, 7, 7)}
    open_ = incremental.open_sessions(spark, str(tmp_path / "progress")).collect()
    assert {(r.run_key, r.requests) for r in open_} == {(3, 2)}
