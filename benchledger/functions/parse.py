"""Load-generator output: text to numbers, validation, and the metrics derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The output grammar and the messages of reports.
MARKER = "JSON:"
MISSING_JSON = "Missing JSON in result"
PARSE_FAILED = "Failed to parse wrk result: "
ERROR_KINDS = (("connect", "Connect"), ("read", "Read"), ("write", "Write"), ("status", "Status"))
REPORTED_PERCENTILE = 95

_STATS = (
    "struct<min:double,mean:double,max:double,stdev:double,percentile:array<array<bigint>>>"
)
OUTPUT_SCHEMA = (
    "struct<summary:struct<duration:bigint,requests:bigint,bytes:bigint,"
    "errors:struct<connect:bigint,read:bigint,write:bigint,status:bigint,timeout:bigint>>,"
    f"latency:{_STATS},requests:{_STATS}>"
)


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column through a generator of one row.

    Later filters and columns read its value. As a plain column, an expensive expression is copied
    into everything that mentions it, and evaluated as often.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def compute_if_complete(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add the decoded output ``value``, null unless complete. Decoded once and checked once per row.

    The check has functions of array elements, which Spark evaluates again in every column that mentions them.
    """
    decoded = compute_once(df, "_decoded", value)
    return compute_once(decoded, name, F.when(is_complete(F.col("_decoded")), F.col("_decoded"))).drop("_decoded")


def json_piece(stdout: Column) -> Column:
    """Text between the first and second marker, or null when there is none.

    Markers with nothing after them do not count, so text that stops at a marker has no JSON; but an
    empty piece counts if something follows the next marker.
    """
    piece = F.split_part(stdout, F.lit(MARKER), F.lit(2))
    # Only an empty piece needs what follows it, which is found by counting characters.
    start = F.locate(MARKER, stdout)
    rest = F.substring(stdout, start + len(MARKER), F.length(stdout))
    followed = (start > 0) & (F.replace(rest, F.lit(MARKER), F.lit("")) != "")
    return F.when(piece != "", piece).when(followed, F.lit(""))


def percentile_value(stats: Column, percentile: int) -> Column:
    """Value paired with ``percentile``; the last pair wins; null when absent."""
    pairs = F.filter(stats["percentile"], lambda pair: F.get(pair, F.lit(0)) == percentile)
    return F.get(F.try_element_at(pairs, F.lit(-1)), F.lit(1))


def _complete_stats(stats: Column) -> Column:
    present = stats["percentile"].isNotNull()
    for field in ("min", "mean", "max", "stdev"):
        present = present & stats[field].isNotNull()
    pairs_hold = F.forall(
        stats["percentile"],
        lambda pair: F.get(pair, F.lit(0)).isNotNull() & F.get(pair, F.lit(1)).isNotNull(),
    )
    return present & F.coalesce(pairs_hold, F.lit(False))


def is_complete(output: Column) -> Column:
    """True when every required number is there. Timeouts are optional: nothing reads them."""
    summary = output["summary"]
    present = F.lit(True)
    for field in ("duration", "requests", "bytes"):
        present = present & summary[field].isNotNull()
    for field, _ in ERROR_KINDS:
        present = present & summary["errors"][field].isNotNull()
    return F.coalesce(
        present
        & _complete_stats(output["latency"])
        & _complete_stats(output["requests"])
        & percentile_value(output["latency"], REPORTED_PERCENTILE).isNotNull(),
        F.lit(False),
    )


def parse_output(df: DataFrame, stdout: str = "stdout") -> DataFrame:
    """Replace the text column by ``output`` (struct, null unless complete) and ``parse_status``.

    Status is one of ``no_stdout``, ``missing_json``, ``parse_failed``, ``parsed``.
    """
    others = [c for c in df.columns if c != stdout]
    found = df.select(*others, F.col(stdout).isNull().alias("_none"), json_piece(F.col(stdout)).alias("_json"))
    checked = compute_if_complete(found, F.from_json("_json", OUTPUT_SCHEMA, {"mode": "PERMISSIVE"}), "output")
    complete = F.col("output").isNotNull()
    return checked.select(
        *others,
        "output",
        F.when(F.col("_none"), "no_stdout")
        .when(F.col("_json").isNull(), "missing_json")
        .when(complete, "parsed")
        .otherwise("parse_failed")
        .alias("parse_status"),
        F.col("_json").alias("json_text"),
    )


def error_free(output: Column) -> Column:
    """No connect, read, write or status errors. Timeouts do not make a run invalid."""
    errors = output["summary"]["errors"]
    clean = F.lit(True)
    for field, _ in ERROR_KINDS:
        clean = clean & (errors[field] == 0)
    return clean


def error_messages(output: Column) -> Column:
    """``"<Kind> errors: <n>"`` per kind that occurred, joined by a comma; empty when there are none."""
    errors = output["summary"]["errors"]
    return F.concat_ws(
        ", ",
        *[
            F.when(errors[field] != 0, F.concat(F.lit(f"{name} errors: "), errors[field].cast("string")))
            for field, name in ERROR_KINDS
        ],
    )


def requests_per_second(output: Column) -> Column:
    """Null for a zero duration: such a run has no rate."""
    summary = output["summary"]
    return F.try_divide(summary["requests"].cast("double"), summary["duration"].cast("double")) * 1000000


def latency_mean_ms(output: Column) -> Column:
    return output["latency"]["mean"] / 1000


def latency_p95_ms(output: Column) -> Column:
    return percentile_value(output["latency"], REPORTED_PERCENTILE).cast("double") / 1000


def metric_columns(output: Column) -> list[Column]:
    return [
        requests_per_second(output).alias("requests_per_second"),
        latency_mean_ms(output).alias("latency_mean_ms"),
        latency_p95_ms(output).alias("latency_p95_ms"),
    ]


def display(rps: Column, mean_ms: Column, p95_ms: Column) -> Column:
    """The metrics as text. The labels."""
    return F.concat(
        F.lit("Requests/s: "), rps.cast("string"),
        F.lit(", Mean latency: "), mean_ms.cast("string"),
        F.lit(", Latency 95%: "), p95_ms.cast("string"),
    )


def measured_execution(executions: Column) -> Column:
    """The last execution of a run (the earlier ones warm up); null for an empty sequence."""
    return F.try_element_at(executions, F.lit(-1))
