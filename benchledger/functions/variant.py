"""Captured output as VARIANT: no schema is fixed, so fields that nobody has declared are kept and can be found.

``functions.parse`` reads the fields that the reports need with a fixed schema, which costs less. This is for
the rest: what a new version of the load generator writes can be listed, counted and read at once.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchledger.functions import parse

#: Levels of objects within objects that ``output_fields`` goes down.
LEVELS = 6


def with_variant(df: DataFrame, stdout: str = "stdout") -> DataFrame:
    """Replace the text column by ``output`` (a variant, null if there is no whole JSON), ``declared`` (its
    declared fields as a struct, null unless complete) and ``parse_status``, as in ``parse.parse_output``.
    """
    others = [c for c in df.columns if c != stdout]
    found = df.select(*others, F.col(stdout).isNull().alias("_none"), parse.json_piece(F.col(stdout)).alias("_json"))
    decoded = parse.compute_once(found, "output", F.try_parse_json("_json"))
    # Null where a field is of another type.
    struct = F.try_variant_get("output", "$", parse.OUTPUT_SCHEMA)
    # Plain columns, which Spark leaves out where nobody reads them; it copies no costly one that is read more than once.
    cast = decoded.withColumn("_decoded", struct)
    checked = cast.withColumn("declared", F.when(parse.is_complete(F.col("_decoded")), F.col("_decoded"))).drop("_decoded")
    complete = F.col("declared").isNotNull()
    return checked.select(
        *others,
        "output",
        "declared",
        F.when(F.col("_none"), "no_stdout")
        .when(F.col("_json").isNull(), "missing_json")
        .when(complete, "parsed")
        .otherwise("parse_failed")
        .alias("parse_status"),
    )


def field(output: Column, path: str, kind: str) -> Column:
    """Any field by its path, such as ``$.latency.p999``; null where it is missing or of another kind."""
    return F.try_variant_get(output, path, kind)


def output_fields(df: DataFrame, output: str = "output") -> DataFrame:
    """(path, kind, outputs): every field of a set of outputs, what it holds, and in how many outputs.

    Objects are opened level by level where the output lies; an array is a field of its own. A field that holds different
    kinds has a row for each.
    """
    # Outputs of one layout, of which there are few, are one row before any is opened: layouts say of each field what it
    # holds, so one output stands for all. The set makes Spark aggregate objects by hash, else it would sort the outputs.
    typed = parse.compute_once(df.select(F.col(output).alias("_output")), "_types", F.schema_of_variant("_output"))
    laid = parse.compute_once(typed, "_layout", _layout(F.col("_types")))
    layouts = laid.filter(F.startswith("_layout", F.lit("OBJECT"))).groupBy("_layout").agg(
        F.count("*").alias("outputs"), F.first("_output").alias("_output"), F.collect_set(F.lit(True)).alias("_set")
    )
    opened = F.array(F.struct(F.lit("$").alias("path"), F.col("_output").alias("value"), F.lit("object").alias("kind")))
    rows = layouts.filter(F.size("_set") == 1).select("outputs", opened.alias("_0"))
    levels = [f"_{level}" for level in range(LEVELS + 1)]
    for above, level in pairwise(levels):
        rows = parse.compute_once(rows, level, _fields(F.col(above)))
    found = F.concat(*[F.transform(level, lambda f: F.struct(f["path"], f["kind"])) for level in levels[1:]])
    fields = rows.select(F.explode(found).alias("_field"), "outputs").select("_field.*", "outputs")
    return fields.groupBy("path", "kind").agg(F.sum("outputs").alias("outputs"))


def _layout(types: Column) -> Column:
    """What ``schema_of_variant`` says, with numbers of any type as one.

    A type stands before a comma or the end of what it is in, and an unquoted name before a colon. Quoted names may look like
    anything, so where there are any the types stay as they are.
    """
    plain = F.regexp_replace(types, "(?:DECIMAL\\([0-9]+,[0-9]+\\)|BIGINT|DOUBLE|FLOAT)(?=[,>])", "N")
    return F.when(F.contains(types, F.lit("`")), types).otherwise(plain)


#: What a type of ``schema_of_variant`` begins with; the others are numbers.
KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}


def _kind(value: Column) -> Column:
    """``object``, ``array``, ``string``, ``boolean``, ``null`` or ``number``. Asks for the type once."""
    first = F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)
    kinds = F.create_map(*[F.lit(word) for pair in KINDS.items() for word in pair])
    return F.coalesce(F.try_element_at(kinds, first), F.lit("number"))


def _fields(opened: Column) -> Column:
    """(path, value, kind) of every field of the objects among the given ones."""

    def fields(row: Column) -> Column:
        entries = F.map_entries(F.try_variant_get(row["value"], "$", "map<string,variant>"))
        return F.transform(
            entries,
            lambda e: F.struct(F.concat_ws(".", row["path"], e["key"]).alias("path"), e["value"].alias("value"), _kind(e["value"]).alias("kind")),
        )

    return F.flatten(F.transform(F.filter(opened, lambda row: row["kind"] == "object"), fields))
