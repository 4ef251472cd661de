"""Runs are narrowed where they are scanned, and arriving shares come in bounded files."""

import datetime as dt
from pathlib import Path

import pytest

from benchledger import queries
from benchledger.operators import ledger
from benchledger.plans import results, tasks

WHEN = dt.datetime(2020, 1, 1)
RUN = "test_run_id string, app_build_id string, test_name string, end_time timestamp_ntz, stdout string"


@pytest.fixture
def tables(spark):
    framework = spark.createDataFrame([(f"f{i}", i % 2, f"c{i % 10}") for i in range(40)], "framework_build_id string, instance_id int, framework_commit string")
    apps = spark.createDataFrame(
        [(f"a{i}", f"f{i % 50}", "app", "x") for i in range(200)] + [(None, "f1", "app", "x")],
        "app_build_id string, framework_build_id string, app_name string, apps_commit string",
    )
    runs = spark.createDataFrame([(f"r{i}", f"a{i % 250}" if i % 7 else None, f"t{i % 3}", WHEN, None) for i in range(1000)], RUN)
    return runs, apps, framework


@pytest.mark.parametrize("words", [1, 4, ledger.FILTER_WORDS])
def test_likely_loses_no_row(spark, monkeypatch, words):
    monkeypatch.setattr(ledger, "FILTER_WORDS", words)
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else str(i % 100)) for i in range(1000)], "i int, k string")
    wanted = spark.createDataFrame([(str(i // 2),) for i in range(40)] + [(None,)], "k string")
    there = {r.i for r in ledger.likely(rows, "k", wanted).collect()}
    assert {r.i for r in rows.join(wanted, "k", "left_semi").collect()} <= there
    assert words < 10 or len(there) < 500
    assert ledger.likely(rows, "k", wanted.limit(0)).count() == 0


def test_last_outcomes_of_wanted_commits(spark, tables):
    wanted = spark.createDataFrame([(1, "c1"), (0, "c4"), (0, "none")], "instance_id int, framework_commit string")
    whole = results.last_outcomes(*tables).join(wanted, ["instance_id", "framework_commit"], "left_semi")
    narrow = results.last_outcomes(*tables, wanted)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, whole.select(*narrow.columns).collect())) != []


def test_text_is_not_shuffled_for_a_window(spark, tables, monkeypatch, capsys):
    monkeypatch.setattr(results, "current_results", lambda valid: valid)
    commits = spark.createDataFrame([("c1",)], "commit_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        results.windowed_results(*tables, commits, 1).explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    text = capsys.readouterr().out
    exchanged = [block for block in text.split("\n\n") if "Exchange" in block.split("\n")[0] and "Input" in block]
    assert exchanged and not any("stdout" in block for block in exchanged)


def test_completed_keys_drop_runs_where_they_are_scanned(spark, tables):
    done = tasks.completed_keys(*tables, same_instance=True)
    expected = ledger.join_runs(tables[0].select("app_build_id", "test_name"), *tables[1:])
    assert sorted(map(tuple, done.collect())) == sorted(map(tuple, expected.select(*done.columns).distinct().collect()))
    assert "_mask" in done._jdf.queryExecution().toString()


def test_arriving_shares_have_as_many_files_each(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "ARRIVING_ROWS", 300)
    rows = spark.range(1000).selectExpr("id", "timestamp_seconds(if(id < 500, 0, id)) as end_time")
    stream = queries._arriving(rows, [0.25, 0.5, 0.75], str(tmp_path / "a"))
    files = list(Path(tmp_path, "a").glob("part-*"))
    assert len(files) == 4 * 4
    seen = []
    query = stream.writeStream.foreachBatch(lambda batch, _: seen.append(batch.count())).option("checkpointLocation", str(tmp_path / "c"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert sum(seen) == 1000 and len(seen) == 4 and max(seen) < 600
    assert spark.read.parquet(str(tmp_path / "a")).groupBy("_metadata.file_path").count().agg({"count": "max"}).first()[0] <= 300
