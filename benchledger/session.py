"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T, T2 = TypeVar("T"), TypeVar("T2")

_local_workspaces: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def build_session(app_name: str = "benchledger", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings this package is tuned for; a cluster may override any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # File sizes say little about parsed rows, so only tiny tables are broadcast on an estimate;
        # larger ones when their measured size allows, else both sides are shuffled and may spill.
        "spark.sql.autoBroadcastJoinThreshold": "1MB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """Shared folder for written intermediates: ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets one temporary folder. On a
    cluster a machine-local folder would be invisible to the other executors, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_workspaces:
        _local_workspaces[context.applicationId] = tempfile.mkdtemp(prefix="benchledger-")
    return _local_workspaces[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the workspace that nothing else uses."""
    path = f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_written(spark: SparkSession) -> int:
    """Delete all that this session has written by ``new_path`` and ``settle``; returns how many paths.

    A result may read such tables long after the function that made them has returned, so the caller says
    when nothing of the session is read any more.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete(spark, path)
    return len(paths)


def delete(spark: SparkSession, path: str) -> None:
    """Delete what is below a path, in whatever store it is."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing = threading.Lock()
_writes: dict[int, int] = {}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files once it is written.

    Else they stay until the driver happens to collect its garbage, which a driver with little to do never does.
    """
    session = spark._jsparkSession.hashCode()
    with _writing:
        _writes[session] = _writes.get(session, 0) + 1
        spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        with _writing:
            _writes[session] -= 1
            if not _writes[session]:
                del _writes[session]
                spark.conf.unset(SHUFFLES_GO)


def settle(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, so an iterative job neither replans nor recomputes earlier rounds, and a lost
    executor costs a re-read and not a re-run. It also pins values which a recomputation could
    change, such as the partition number after a range shuffle. Ids are hexadecimal text, which zstd
    halves and the default codec leaves as it is. A caller that deletes the table names its ``path``.
    """
    path = path or new_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def beside(work: Callable[[], T], other: Callable[[], T2]) -> tuple[T, T2]:
    """The results of both, which run at the same time: a chain of small jobs leaves most of a cluster idle."""
    with ThreadPoolExecutor(1) as pool:
        started = pool.submit(inheritable_thread_target(work))
        mine = other()
        return started.result(), mine
