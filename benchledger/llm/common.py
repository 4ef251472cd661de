"""Small helpers that several corpus operators use."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

A_TO_Z = bytes(range(65, 91))
#: For ``bytes.translate``: lower-cases A-Z and nothing else.
LOWER_AZ = bytes.maketrans(A_TO_Z, A_TO_Z.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo ``modulus``; a null key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def lower_az(text: Column) -> Column:
    return F.translate(text, A_TO_Z.decode(), A_TO_Z.lower().decode())


#: Where the columns are that an operator does not read.
OTHERS = "_others"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def set_apart(rows: DataFrame, *read: str) -> DataFrame:
    """The columns that an operator reads, by these names, and all others as one struct.

    So no column of a corpus, whatever its name, clashes with one that the operator makes on its way.
    """
    names = {name.lower(): name for name in rows.columns}
    rest = [quoted(name) for low, name in names.items() if low not in map(str.lower, read)]
    own = [quoted(names[name.lower()]).alias(name) for name in read]
    return rows.select(*own, F.struct(*(rest or [F.lit(0).alias("_")])).alias(OTHERS))


def put_back(rows: DataFrame, documents: DataFrame, read: Sequence[str], made: Mapping[str, Column]) -> DataFrame:
    """The columns of ``documents``, in order, and those that an operator made of rows from :func:`set_apart`.

    A column whose name is that of a made one, in whatever case, is replaced.
    """
    own = {name.lower(): name for name in read}
    replaced = {name.lower() for name in made}
    kept = [
        (F.col(own[name.lower()]) if name.lower() in own else F.col(OTHERS).getField(name)).alias(name)
        for name in documents.columns
        if name.lower() not in replaced
    ]
    return rows.select(*kept, *[column.alias(name) for name, column in made.items()])


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """The column's values; null is the empty text."""
    return [value or "" for value in batch.column(name).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], name: str, limit: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of the column, or of one row if that alone is longer.

    Arrow batches are bounded by rows; long texts would make the arrays that are derived from them large.
    """
    for batch in batches:
        column = batch.column(name)
        if batch.num_rows <= 1 or column.nbytes <= limit:
            yield batch
            continue
        sizes = np.fromiter((len(value.as_buffer()) if value.is_valid else 0 for value in column), np.int64)
        start, size = 0, 0
        for row, own in enumerate(sizes.tolist()):
            if row > start and size + own > limit:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += own
        yield batch.slice(start)


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of 64-bit values (the finaliser of splitmix64)."""
    x = values + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
