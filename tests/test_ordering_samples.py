import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from benchledger.operators import samples
from benchledger.operators.ordering import number_rows, prefix_sums, with_previous
from benchledger.session import settle


def hot_rows(seed=5, size=600):
    """(key, value, cost): one key holds a third of all rows, and values repeat."""
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.34 else f"k{rng.randrange(20)}", i, rng.randrange(50), rng.randrange(9))
        for i in range(size)
    ]


@pytest.mark.parametrize("block_rows", [7, 100_000])
def test_numbers_sums_and_previous(spark, block_rows):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "key string, id int, value int, cost bigint").repartition(7)
    numbered = settle(number_rows(df, [F.col("value").desc(), F.col("id").asc()], ["key"]), "t")
    summed = prefix_sums(numbered, {"before": "cost"}, partition=["key"], block_rows=10)
    stepped = with_previous(summed, ["id", "value"], partition=["key"], block_rows=block_rows).collect()
    assert len(stepped) == len(rows)
    by_key = {}
    for row in stepped:
        by_key.setdefault(row.key, {})[row.seq] = row
    for key, found in by_key.items():
        expected = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[2], r[1]))
        before, previous = 0, (None, None)
        for seq, (_, row_id, value, cost) in enumerate(expected, 1):
            row = found[seq]
            assert (row.id, row.before) == (row_id, before)
            assert (row.previous_id, row.previous_value) == previous
            before, previous = before + cost, (row_id, value)


def test_numbers_without_partition(spark):
    df = spark.createDataFrame([(i,) for i in random.Random(1).sample(range(1000), 300)], "v int")
    found = sorted((r.seq, r.v) for r in number_rows(df, [F.col("v").asc()]).collect())
    assert [s for s, _ in found] == list(range(1, 301))
    assert [v for _, v in found] == sorted(v for _, v in found)


def sample_frame(spark, values):
    base = dt.datetime(2024, 1, 1)
    rows = [
        (run, base + dt.timedelta(seconds=i), v, "error" if i % 5 == 0 else "view")
        for run, latencies in values.items()
        for i, v in enumerate(latencies)
    ]
    return spark.createDataFrame(rows, "run_key bigint, ts timestamp_ntz, latency_us bigint, outcome string")


def latencies():
    rng = random.Random(9)
    return {
        1: [rng.randrange(1, 2_000_000) for _ in range(700)],
        2: [7],
        3: [511, 512, 513, 1023, 1024, 1025, 0, 1] * 3,
        4: [2**40 + rng.randrange(5) for _ in range(101)],
        5: [100] * 250,
    }


def test_exact_percentiles(spark):
    values = latencies()
    found = {
        (r.run_key, r.percentile): r.latency_us for r in samples.sample_percentiles(sample_frame(spark, values)).collect()
    }
    expected = {
        (run, p): sorted(v)[math.ceil(p * len(v) / 100) - 1] for run, v in values.items() for p in samples.PERCENTILES
    }
    assert found == expected


def test_approximate_percentiles_stay_within_rank_error(spark):
    values, accuracy = latencies(), 100
    for row in samples.sample_percentiles_approx(sample_frame(spark, values), accuracy=accuracy).collect():
        ordered = sorted(values[row.run_key])
        low = sum(v < row.latency_us for v in ordered)
        high = sum(v <= row.latency_us for v in ordered)
        slack = len(ordered) / accuracy + 1
        assert low - slack <= row.percentile * len(ordered) / 100 <= high + slack


def test_stats_totals_and_warm_up(spark):
    values = latencies()
    frame = sample_frame(spark, values)
    stats = {r.run_key: r for r in samples.sample_stats(frame).collect()}
    for run, v in values.items():
        assert (stats[run].n, stats[run].min_us, stats[run].max_us) == (len(v), min(v), max(v))
        assert math.isclose(stats[run].mean_us, statistics.fmean(v), rel_tol=1e-12)
        if len(v) > 1:
            assert math.isclose(stats[run].stdev_us, statistics.stdev(v), rel_tol=1e-9, abs_tol=1e-9)
    assert stats[2].stdev_us is None

    totals = {r.run_key: r for r in samples.sample_totals(frame).collect()}
    assert (totals[1].requests, totals[1].status_errors, totals[1].duration_us) == (700, 140, 699_000_000)

    kept = samples.after_warm_up(frame, 100).groupBy("run_key").count().collect()
    assert {r.run_key: r["count"] for r in kept} == {1: 600, 4: 1, 5: 150}


def test_written_tables_can_be_removed(tmp_path):
    """In its own process, since the tables of a running session are removed."""
    import subprocess
    import sys

    code = f"""
import os
from benchledger.session import build_session, remove_written, settle
spark = build_session("remove", "local[1]", **{{"spark.checkpoint.dir": "file://{tmp_path}"}})
def there():
    return [name for name in os.listdir("{tmp_path}") if name.startswith("numbers-")]
assert settle(spark.range(3), "numbers").count() == 3 and len(there()) == 1
assert remove_written(spark) == 1 and there() == [] and remove_written(spark) == 0
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
