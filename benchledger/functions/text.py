"""Scalar text and number helpers as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sampling prefix, captured-output limit and its notice, version line, record id.
SAMPLE_DIGITS = 7
OUTPUT_LIMIT = 1024 * 1024
VERSION_LINE = '(?s)^(.*)ersion in ThisBuild := "(.*)"(.*)$'
UUID_TEXT = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
SHORT_ID_LENGTH = 7


def sample_ceiling(rate: float) -> int:
    """Largest sampled prefix for a rate in [0, 1], rounded half up."""
    largest = 16**SAMPLE_DIGITS - 1
    return math.floor(largest * rate + 0.5)


def sample_ceiling_column(rate: Column) -> Column:
    return F.floor(F.lit(16**SAMPLE_DIGITS - 1) * rate + F.lit(0.5)).cast("bigint")


def sample_prefix(commit_id: Column) -> Column:
    return F.conv(F.substring(commit_id, 1, SAMPLE_DIGITS), 16, 10).cast("bigint")


def short_id(commit_id: Column) -> Column:
    return F.substring(commit_id, 1, SHORT_ID_LENGTH)


def trim_controls(text: Column) -> Column:
    """Strip every character up to and including the space from both ends."""
    return F.regexp_replace(text, "^[\\x00-\\x20]+|[\\x00-\\x20]+$", "")


def version_of(text: Column) -> Column:
    """Version named in a build file, or null when no line sets one. Runs to the last quote."""
    trimmed = trim_controls(text)
    return F.when(trimmed.rlike(VERSION_LINE), F.regexp_extract(trimmed, VERSION_LINE, 2))


def is_uuid(text: Column) -> Column:
    return F.coalesce(text.rlike(UUID_TEXT), F.lit(False))


def uuid_text(hex32: Column) -> Column:
    """Canonical UUID spelling of 32 hex digits."""
    return F.regexp_replace(hex32, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def base_name(file_name: Column) -> Column:
    """Text before the last dot."""
    return F.regexp_extract(file_name, "^(.*)\\.[^.]*$", 1)


def last_segment(ref_name: Column) -> Column:
    return F.substring_index(ref_name, "/", -1)


def cap_output(text: Column, limit: int = OUTPUT_LIMIT) -> Column:
    """First ``limit`` bytes read as ASCII, then a notice if anything was cut.

    A byte outside ASCII decodes to U+FFFD, so a character of k bytes becomes k of them; after that
    one character is one byte and the cut can count characters. Three-byte characters go first,
    because U+FFFD is one of them.
    """
    ascii_text = text
    for char_range, size in (
        ("[\\x{800}-\\x{FFFF}]", 3),
        ("[\\x{10000}-\\x{10FFFF}]", 4),
        ("[\\x{80}-\\x{7FF}]", 2),
    ):
        ascii_text = F.regexp_replace(ascii_text, char_range, "\uFFFD" * size)
    notice = f"\n--- Truncated output to {limit} bytes ---"
    return F.when(
        F.length(ascii_text) > limit, F.concat(F.substring(ascii_text, 1, limit), F.lit(notice))
    ).otherwise(ascii_text)
