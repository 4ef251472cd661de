"""Time arithmetic on whole seconds, minutes and microseconds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form a record time may have besides epoch milliseconds.
RECORD_TIME = "yyyy-MM-dd'T'HH:mm:ssz"

MINUTE_MICROS = 60_000_000


def record_time(text: Column) -> Column:
    """Time of a record: epoch milliseconds or zoned text."""
    return F.coalesce(
        F.timestamp_millis(text.try_cast("bigint")),
        F.try_to_timestamp(text, F.lit(RECORD_TIME)),
    )


def commit_time(epoch_seconds: Column) -> Column:
    return F.timestamp_seconds(epoch_seconds)


def elapsed_micros(start: Column, end: Column) -> Column:
    return F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Whole minutes between two times, cut towards zero."""
    micros = elapsed_micros(start, end)
    return ((micros - micros % MINUTE_MICROS) / MINUTE_MICROS).cast("bigint")


def window_start(as_of: dt.datetime, duration: dt.timedelta) -> dt.datetime:
    """Start of a report window: whole hours before ``as_of``."""
    hours = int(duration.total_seconds() // 3600)
    return as_of - dt.timedelta(hours=hours)
