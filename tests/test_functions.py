import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from benchledger.functions import commands, text, times
from benchledger.operators import builds, commits, samples
from benchledger.sources import matrix


def evaluate(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row.out for row in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_sampling_limits(spark):
    def picked(commit_id, rate):
        return spark.range(1).select(commits.sampled(F.lit(commit_id), F.lit(rate)).alias("p")).first().p

    assert text.sample_ceiling(0.5) == int("8000000", 16)
    assert picked("0000000abc", 0.0)
    assert not picked("0000001abc", 0.0)
    assert picked("8000000abc", 0.5) and picked("7ffffffabc", 0.5)
    assert not picked("8000001abc", 0.5)
    assert picked("fffffffabc", 1.0)


@given(st.floats(0, 1), st.floats(0, 1))
def test_sampling_is_monotone(a, b):
    low, high = sorted((a, b))
    assert text.sample_ceiling(low) <= text.sample_ceiling(high)


def test_versions(spark):
    found = evaluate(
        spark,
        [
            'Release.branchVersion in ThisBuild := "2.4.0-SNAPSHOT"',
            'version in ThisBuild := "2.5.0-SNAPSHOT"',
            '//\n// Copyright\n//\n\nversion in ThisBuild := "2.5.0"\n',
            'version in ThisBuild := "2.5.0" // "x"',
            "name := none",
        ],
        text.version_of,
    )
    assert found == ["2.4.0-SNAPSHOT", "2.5.0-SNAPSHOT", "2.5.0", '2.5.0" // "x', None]


@pytest.mark.parametrize("limit", [1, 5, 8, 100])
def test_output_cap_matches_bytes(spark, limit):
    values = ["", "abcde", "abcdefgh", "aé€😀z", "��", "ééééé", "x" * 99 + "é"]
    notice = f"\n--- Truncated output to {limit} bytes ---"

    def captured(value):
        raw = value.encode()
        kept = "".join(chr(b) if b < 128 else "�" for b in raw[:limit])
        return kept + notice if len(raw) > limit else kept

    assert evaluate(spark, values, lambda v: text.cap_output(v, limit)) == [captured(v) for v in values]


def test_record_times(spark):
    found = evaluate(
        spark,
        ["1456827630000", "2016-03-01T10:20:30UTC", "yesterday", None],
        lambda v: times.record_time(v).cast("string"),
    )
    assert found == ["2016-03-01 10:20:30", "2016-03-01 10:20:30", None, None]


def test_elapsed_minutes(spark):
    def minutes(seconds):
        start = F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz")
        end = F.lit(dt.datetime(2020, 1, 1) + dt.timedelta(seconds=seconds)).cast("timestamp_ntz")
        return spark.range(1).select(times.elapsed_minutes(start, end).alias("m")).first().m

    assert [minutes(s) for s in (0, 59.999999, 60, 61, 3600, -59, -61)] == [0, 0, 1, 1, 60, 0, -1]


def test_window_start_is_whole_hours():
    assert times.window_start(dt.datetime(2020, 1, 2), dt.timedelta(hours=1, minutes=59)) == dt.datetime(2020, 1, 1, 23)


def test_range_parts(spark):
    values = ["a..b", "a", "a..b..c", "a..", "..b", "a...b", "", ".."]
    sizes = evaluate(spark, values, lambda v: F.size(matrix.range_parts(v)))
    assert sizes == [2, 1, 3, 1, 2, 2, 0, 0]


def test_uuid_and_names(spark):
    digits = "0123456789abcdef0123456789abcdef"
    assert evaluate(spark, [digits], text.uuid_text) == ["01234567-89ab-cdef-0123-456789abcdef"]
    assert evaluate(spark, ["01234567-89ab-cdef-0123-456789abcdef", digits, None], text.is_uuid) == [True, False, False]
    assert evaluate(spark, ["a.b.json"], text.base_name) == ["a.b"]
    assert evaluate(spark, ["refs/heads/2.5.x", "main"], text.last_segment) == ["2.5.x", "main"]


def test_command_rendering(spark):
    command = F.struct(
        F.lit("<apps.home>/run").alias("program"),
        F.array(F.lit("-s<assets.home>/a"), F.lit("<assets.home><assets.home>")).alias("args"),
        F.lit("<apps.home>").alias("workingDir"),
        F.create_map(F.lit("JAVA_HOME"), F.lit("<java8.home>")).alias("env"),
    )
    values = {"<assets.home>": "/as", "<apps.home>": "/ap", "<java8.home>": "/j"}
    row = spark.range(1).select(commands.render_command(command, values).alias("c")).first().c
    assert (row.program, row.args, row.workingDir, row.env) == (
        "/ap/run", ["-s/as/a", "/as/as"], "/ap", {"JAVA_HOME": "/j"},
    )


def test_effective_duration(spark):
    def seconds(override):
        return spark.range(1).select(commands.effective_duration(F.lit(120), override).alias("s")).first().s

    assert [seconds(o) for o in (None, 10, 500)] == [120, 10, 120]


def test_build_success(spark):
    rows = [(0, []), (1, [0, 0]), (2, [0, None]), (3, [0, 1])]
    df = spark.createDataFrame([(i, [(c,) for c in codes]) for i, codes in rows], "i int, e array<struct<returnCode:int>>")
    found = [r.ok for r in df.select("i", builds.succeeded(F.col("e")).alias("ok")).orderBy("i").collect()]
    assert found == [True, True, False, False]


def test_small_helpers(spark):
    row = spark.range(1).select(
        times.commit_time(F.lit(1456827630)).cast("string").alias("time"),
        samples.status_outcome(F.lit(399)).alias("fine"),
        samples.status_outcome(F.lit(400)).alias("error"),
        commands.timeout_millis(F.lit(120)).alias("timeout"),
        text.short_id(F.lit("0123456789")).alias("short"),
    ).first()
    assert tuple(row) == ("2016-03-01 10:20:30", "ok", "status", 130000, "0123456")
