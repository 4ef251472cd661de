"""Commands of a task: placeholders filled in, load-generator arguments, effective durations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds a load run may overstay before it is stopped.
TIMEOUT_MARGIN_SECONDS = 10


def fill_placeholders(text: Column, values: Mapping[str, str]) -> Column:
    """Replace every placeholder, in the given order."""
    for placeholder, value in values.items():
        text = F.replace(text, F.lit(placeholder), F.lit(value))
    return text


def render_command(command: Column, values: Mapping[str, str]) -> Column:
    """Fill placeholders in the program, every argument, the directory and every environment value."""
    return F.struct(
        fill_placeholders(command["program"], values).alias("program"),
        F.transform(command["args"], lambda arg: fill_placeholders(arg, values)).alias("args"),
        fill_placeholders(command["workingDir"], values).alias("workingDir"),
        F.transform_values(command["env"], lambda _, value: fill_placeholders(value, values)).alias("env"),
    )


def effective_duration(configured: Column, override: Column | int | None) -> Column:
    """The configured seconds, or the override when that is shorter."""
    if override is None:
        return configured
    return F.least(configured, override if isinstance(override, Column) else F.lit(override))


def timeout_millis(duration_seconds: Column) -> Column:
    return (duration_seconds + TIMEOUT_MARGIN_SECONDS).cast("bigint") * 1000


def load_command(
    wrk_args: Column, duration_seconds: Column, working_dir: str, threads: int = 16, connections: int = 32
) -> Column:
    """Load-generator command struct: threads, connections and duration come before the test's arguments."""
    return F.struct(
        F.lit("wrk").alias("program"),
        F.concat(
            F.array(
                F.lit(f"-t{threads}"),
                F.lit(f"-c{connections}"),
                F.concat(F.lit("-d"), duration_seconds.cast("string"), F.lit("s")),
            ),
            wrk_args,
        ).alias("args"),
        F.lit(working_dir).alias("workingDir"),
        F.create_map().cast("map<string,string>").alias("env"),
    )
