"""Incremental work: new records only, results kept up to date, samples rolled up as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from benchledger.operators import sketches
from benchledger.operators.ledger import join_builds, latest_by
from benchledger.plans.results import METRICS, run_outcomes
from benchledger.schemas import RecordLayout
from benchledger.session import delete
from benchledger.sources import records

RESULT_KEY = ["instance_id", "framework_commit", "test_name"]


def stream_records(
    spark: SparkSession,
    path: str,
    table: str,
    layout: RecordLayout = RecordLayout(),
    archive: bool = False,
    max_files: int = 10_000,
    pattern: str = "*.json",
) -> DataFrame:
    """Record files as a stream; every file is read once."""
    stream = (
        spark.readStream.schema(records.record_schema(table, layout))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("multiLine", not archive)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
        .json(path)
    )
    return stream if archive else records.with_file_id(stream)


def ingest(
    stream: DataFrame,
    table: str,
    ledger: str,
    checkpoint: str,
    layout: RecordLayout = RecordLayout(),
    quarantine: str | None = None,
) -> StreamingQuery:
    """Append usable records to a ledger and the others to ``quarantine``, one batch directory per micro-batch.

    The quarantine is next to the ledger if no place is named. A batch that is run again after a failure
    overwrites its own directories, so no record is stored twice. A batch is parsed once, into a table next to the
    ledger that goes when both are written.
    """
    quarantine = quarantine or f"{ledger.rstrip('/')}-quarantine"
    arrived = f"{ledger.rstrip('/')}-arrived"

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = records.checked_rows(batch, table, layout)
        records.append_batch(rows, arrived, batch_id)
        good, bad = records.parted(batch.sparkSession.read.schema(rows.schema).parquet(f"{arrived}/batch_id={batch_id}"))
        records.append_batch(good, ledger, batch_id)
        records.append_batch(bad, quarantine, batch_id)
        delete(batch.sparkSession, arrived)

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


RUN_KEY = ["app_build_id", "test_name"]
LATEST_RUNS = (
    "app_build_id string, test_name string, test_run_id string, end_time timestamp, "
    "requests_per_second double, latency_mean_ms double, latency_p95_ms double"
)


def keep_latest_results(runs: DataFrame, state: str, checkpoint: str) -> StreamingQuery:
    """Keep the last valid run per app build and test up to date.

    A run's build may arrive later than the run, so builds are joined by ``read_latest_results`` and not
    here. Each micro-batch stores only its own latest row per key; the order is by (end time, run id),
    so neither the split into batches nor the order of arrival matters.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        ok = run_outcomes(batch).filter(F.col("outcome") == "ok")
        records.append_batch(_latest(ok, RUN_KEY), state, batch_id)

    return (
        runs.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def join_streams(runs: DataFrame, app_builds: DataFrame, delay: str, longest: str) -> DataFrame:
    """Streams of runs and of app builds, joined as they arrive, whichever comes first.

    A run ends within ``longest`` after the end of its build. ``state`` is ``joined``, or ``dangling`` once
    the watermark (``delay`` behind the newest rows of either stream) says that the build will not come any
    more. So neither side is kept for longer than the two times together.
    """
    built = app_builds.select(
        F.col("app_build_id").alias("_build"), "framework_build_id", "app_name", "apps_commit", F.col("end_time").alias("built_at")
    ).withWatermark("built_at", delay)
    in_time = F.col("end_time").between(F.col("built_at"), F.col("built_at") + F.expr(f"INTERVAL {longest}"))
    joined = runs.withWatermark("end_time", delay).join(built, (F.col("app_build_id") == F.col("_build")) & in_time, "left_outer")
    return joined.withColumn("state", F.when(F.col("_build").isNull(), "dangling").otherwise("joined")).drop("_build", "built_at")


STATE_CODEC = "spark.sql.streaming.stateStore.compression.codec"


def store_stream(stream: DataFrame, target: str, checkpoint: str, state_codec: str | None = None) -> StreamingQuery:
    """Write what a stream has settled, until all input that is there now has been read.

    ``state_codec`` compresses the state of a checkpoint that is new; the checkpoint remembers it.
    """
    conf = stream.sparkSession.conf
    before = conf.get(STATE_CODEC)
    conf.set(STATE_CODEC, state_codec or before)
    try:  # a query takes a copy of the settings as it starts
        return (
            stream.writeStream.format("parquet")
            .option("path", target)
            .option("compression", "zstd")
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        conf.set(STATE_CODEC, before)


def _latest(results: DataFrame, key: list[str]) -> DataFrame:
    return latest_by(results, key, ["end_time", "test_run_id"], ["test_run_id", "end_time", *METRICS])


def _folded(spark: SparkSession, state: str) -> DataFrame:
    return _latest(records.read_batches(spark, state, LATEST_RUNS), RUN_KEY)


def read_latest_results(
    spark: SparkSession, state: str, app_builds: DataFrame, framework_builds: DataFrame
) -> DataFrame:
    """The last valid run per instance, commit and test, of the runs whose builds are known by now."""
    builds = join_builds(app_builds, framework_builds).select("app_build_id", "instance_id", "framework_commit")
    return _latest(_folded(spark, state).join(builds, "app_build_id"), RESULT_KEY)


def compact_results(spark: SparkSession, state: str, target: str) -> None:
    """Fold all batches into a new state directory that holds one row per key.

    To be called between runs of the stream, so that a read costs what the keys need and not what all
    batches held.
    """
    records.append_batch(_folded(spark, state), target, 0)


def sample_roll_up(samples: DataFrame, quiet: str, delay: str, accuracy: int = 10_000) -> DataFrame:
    """One row per run and stretch of activity, closed after ``quiet`` without samples.

    Percentiles are sketches: exact up to ``accuracy`` samples, within n / accuracy ranks beyond.
    Emitted once the watermark (``delay`` behind the newest sample) has passed the end.
    """
    return _rolled_up(samples.withWatermark("ts", delay), quiet, accuracy)


def _rolled_up(samples: DataFrame, quiet: str, accuracy: int) -> DataFrame:
    return (
        samples.groupBy("run_key", F.session_window("ts", quiet).alias("session"))
        .agg(
            F.count("*").alias("requests"),
            F.sum("latency_us").alias("latency_sum_us"),
            F.min("latency_us").alias("min_us"),
            F.max("latency_us").alias("max_us"),
            F.percentile_approx("latency_us", [0.5, 0.95], accuracy).alias("_percentiles"),
            F.count_if(F.col("outcome").isin("status", "error")).alias("status_errors"),
        )
        .select(
            "run_key",
            F.col("session.start").alias("started"),
            F.col("session.end").alias("closed"),
            "requests",
            "latency_sum_us",
            "min_us",
            "max_us",
            F.col("_percentiles")[0].alias("p50_us"),
            F.col("_percentiles")[1].alias("p95_us"),
            "status_errors",
        )
    )


def sample_sketch_roll_up(samples: DataFrame, quiet: str, delay: str) -> DataFrame:
    """As ``sample_roll_up``, with a sketch of the latencies in place of two percentiles.

    Sketches of sessions can be merged, and those of sessions that are still open are read out of the
    stream's state by ``open_sessions``.
    """
    session = F.session_window("ts", quiet).alias("session")
    columns = _session_columns()
    sessions = samples.withWatermark("ts", delay).groupBy("run_key", session)
    return sessions.agg(*[column.alias(name) for name, column in columns.items()]).select(
        "run_key", F.col("session.start").alias("started"), F.col("session.end").alias("closed"), _requests(), *columns
    )


SKETCHED = (
    "run_key bigint, started timestamp, closed timestamp, requests bigint, latency_sum_us bigint, "
    "min_us bigint, max_us bigint, status_errors bigint, sketch binary"
)


def _session_columns() -> dict[str, Column]:
    """What a session gathers, in the order of the state's columns, whose names must differ; the sketch counts."""
    return {
        "latency_sum_us": F.sum("latency_us"),
        "min_us": F.min("latency_us"),
        "max_us": F.max("latency_us"),
        "status_errors": F.count_if(F.col("outcome").isin("status", "error")),
        "sketch": F.kll_sketch_agg_bigint("latency_us", F.lit(sketches.KLL_SIZE)),
    }


def open_sessions(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The sessions that a stopped ``sample_sketch_roll_up`` still holds, out of its state; no sample is read.

    ``batch_id`` names an earlier state than the last one.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    # The state has a session's key and window, then what is aggregated, in order.
    columns = _session_columns()
    state = reader.load(checkpoint).select("value.*").toDF("run_key", "session", *columns)
    window = [F.col("session.start").alias("started"), F.col("session.end").alias("closed")]
    return state.select("run_key", *window, _requests(), *columns)


def _requests() -> Column:
    return F.kll_sketch_get_n_bigint("sketch").alias("requests")


def late_samples(query: StreamingQuery) -> int:
    """How many samples came after their session was closed, of the progress that the query still remembers."""
    return sum(op["numRowsDroppedByWatermark"] for progress in query.recentProgress for op in progress["stateOperators"])


def with_percentiles(sessions: DataFrame) -> DataFrame:
    """``p50_us`` and ``p95_us`` in place of the sketch."""
    levels = {"p50_us": 0.5, "p95_us": 0.95}
    values = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(level)).alias(name) for name, level in levels.items()]
    return sessions.select(*[c for c in sessions.columns if c != "sketch"], *values)


ROLLED_UP = (
    "run_key bigint, started timestamp, closed timestamp, requests bigint, latency_sum_us bigint, "
    "min_us bigint, max_us bigint, p50_us bigint, p95_us bigint, status_errors bigint"
)


def with_open_sessions(closed: DataFrame, samples: DataFrame, quiet: str) -> DataFrame:
    """The stream's sessions (state ``closed``) and what it does not hold, so that every sample counts once.

    Sessions that are still open at the end of the input are rolled up here from the samples after the
    run's last closed session (``open``). Samples that came too late for a session that was closed
    already are counted per run (``late``).
    """
    last = closed.groupBy("run_key").agg(F.max("closed").alias("_last"), F.sum("requests").alias("_held"))
    placed = samples.join(last, "run_key", "left")
    after = placed.filter(F.col("_last").isNull() | (F.col("ts") >= F.col("_last"))).drop("_last", "_held")
    open_ = _rolled_up(after, quiet, 10_000)
    before = placed.filter(F.col("ts") < F.col("_last")).groupBy("run_key").agg(
        (F.count("*") - F.max("_held")).alias("requests")
    )
    late = before.filter("requests > 0").withColumn("state", F.lit("late"))
    return (
        closed.withColumn("state", F.lit("closed"))
        .unionByName(open_.withColumn("state", F.lit("open")))
        .unionByName(late, allowMissingColumns=True)
    )
