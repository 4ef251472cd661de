"""Benchmark passages in documents, found by one Aho-Corasick automaton.

A word is a run of letters, digits and non-ASCII characters, with A-Z lower-cased. A window is ten
consecutive words of a benchmark item; an item of fewer words, but not none, is one window. The
automaton holds every window as its words with a space on either side. A document is normalised to
the same form and scanned once; the end of a match gives the words that it covers, and the
normalised words' places give their offsets in the document.

An automaton must fit into a worker. A benchmark of at most ``block_bytes`` of text goes to all tasks as one. A larger
one is a written table of blocks of that size; documents are dealt into parts of bounded size, every part meets every
block in a task that reads both, and what the blocks find is united by an aggregation. The driver holds no more than
one block's text at any size.

Null and empty documents have no words and are clean; an empty benchmark leaves all documents clean.
Repeated documents and items are treated alike, each on its own. A null item_id takes no part. Other columns, whatever
their names, stay as they are.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchledger.llm.common import put_back, set_apart
from benchledger.operators.ordering import number_rows, prefix_sums
from benchledger.session import settle

WINDOW = 10
#: Bytes of benchmark text in one automaton.
BLOCK_BYTES = 32_000_000
#: Bytes of documents that meet a block in one task, if there are several blocks.
PART_BYTES = 64_000_000
#: Every byte that is part of a word, A-Z lower-cased; the others become spaces.
NORMAL = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 0x80 or chr(byte).isalnum() else 32 for byte in range(256)
)
WORD = re.compile(rb"[^ ]+")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(NORMAL).split()


def windows_of(words: list[bytes]) -> set[bytes]:
    size = min(WINDOW, len(words))
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


class Automaton:
    """Windows of benchmark items, and the items of each."""

    def __init__(self, items: tuple[tuple[int, str], ...]):
        by_window: dict[bytes, set[int]] = {}
        for item, text in items:
            for window in windows_of(words_of(text)):
                by_window.setdefault(window, set()).add(item)
        self.items = [frozenset(owners) for owners in by_window.values()]
        self.sizes = [window.count(b" ") + 1 for window in by_window]
        self.machine = ahocorasick.Automaton()
        for number, window in enumerate(by_window):
            # One character for a byte.
            self.machine.add_word(f" {window.decode('latin-1')} ", number)
        if by_window:
            self.machine.make_automaton()

    def scan(self, text: str) -> tuple[int, np.ndarray, set[int]]:
        """Number of words, indexes of the words that are hit, items that occur."""
        words = words_of(text)
        none = np.zeros(0, np.int64)
        if not words or not self.items:
            return len(words), none, set()
        normal = f" {b' '.join(words).decode('latin-1')} "
        found = list(self.machine.iter(normal))
        if not found:
            return len(words), none, set()
        # The space at the end of a match follows word number (spaces before it) - 1.
        spaces = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), np.uint8) == 32)
        ends = np.searchsorted(spaces, [end for end, _ in found])
        numbers = {number for _, number in found}
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, ends - np.array([self.sizes[number] for _, number in found]), 1)
        np.add.at(edges, ends, -1)
        hit = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        return len(words), hit, set().union(*(self.items[number] for number in numbers))


def hit_spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code-point offsets in the text of runs of hit words, from the first to the last word's end."""
    if not len(hit):
        return []
    data = text.encode("utf-8")
    places = [match.span() for match in WORD.finditer(data.translate(NORMAL))]
    # Code points before each byte: bytes that do not continue a character.
    points = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
    runs = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
    return [(int(points[places[run[0]][0]]), int(points[places[run[-1]][1]])) for run in runs]


@lru_cache(maxsize=2)
def automaton(items: tuple[tuple[int, str], ...]) -> Automaton:
    """One for each Python worker and block."""
    return Automaton(items)


FOUND = "n_words bigint, hit_words array<bigint>, items array<bigint>"


def scanned(text: Column, items: tuple[tuple[int, str], ...]) -> Column:
    """A struct of n_words, hit_words and items."""

    def run(texts: pa.Array) -> pa.Array:
        machine = automaton(items)
        found = [machine.scan(text or "") for text in texts.to_pylist()]
        columns = [
            pa.array([size for size, _, _ in found], pa.int64()),
            pa.array([hit.tolist() for _, hit, _ in found], pa.list_(pa.int64())),
            pa.array([sorted(owners) for _, _, owners in found], pa.list_(pa.int64())),
        ]
        return pa.StructArray.from_arrays(columns, ["n_words", "hit_words", "items"])

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, FOUND)(text)


def with_spans(text: Column, hit_words: Column) -> Column:
    def run(texts: pa.Array, hits: pa.Array) -> pa.Array:
        pairs = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        found = [
            [{"start": a, "end": b} for a, b in hit_spans(text or "", np.array(hit, np.int64))]
            for text, hit in zip(texts.to_pylist(), hits.to_pylist(), strict=True)
        ]
        return pa.array(found, pa.list_(pairs))

    run.__annotations__ = {"texts": pa.Array, "hits": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<struct<start:bigint,end:bigint>>")(text, hit_words)


def in_blocks(rows: DataFrame, items: DataFrame, block_bytes: int, part_bytes: int) -> DataFrame:
    """``rows`` (with text) and ``_found``, for a benchmark of several blocks; ``items`` is a written table."""
    numbered = settle(number_rows(items, [F.col("item_id"), F.col("text")]), "benchmark-numbered")
    sizes = numbered.withColumn("size", F.length("text").cast("bigint"))
    placed = prefix_sums(sizes, {"before": "size"}).select("item_id", "text", F.floor(F.col("before") / block_bytes).cast("int").alias("block"))
    blocks = settle(placed, "benchmark-blocks")
    rows = settle(rows.withColumn("_id", F.monotonically_increasing_id()), "contaminated-rows")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(size / part_bytes))
    part = F.pmod(F.xxhash64("_id"), F.lit(parts)).cast("int")
    every_block = F.array_sort(F.array(*[F.lit(row["block"]) for row in blocks.select("block").distinct().collect()]))
    documents = rows.select("_id", "text", part.alias("part"), F.explode(every_block).alias("block"))
    each_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    benchmark = blocks.select("item_id", F.col("text").alias("item"), "block", each_part.alias("part"))

    def scan(texts: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        machine = Automaton(tuple(zip(block["item_id"].tolist(), block["item"].tolist(), strict=True)))
        found = [machine.scan(text or "") for text in texts["text"]]
        return pd.DataFrame(
            {
                "_id": texts["_id"],
                "n_words": [size for size, _, _ in found],
                "hit_words": pd.Series([hit.tolist() for _, hit, _ in found], dtype=object),
                "items": pd.Series([sorted(owners) for _, _, owners in found], dtype=object),
            }
        )

    met = documents.groupBy("part", "block").cogroup(benchmark.groupBy("part", "block")).applyInPandas(scan, f"_id bigint, {FOUND}")
    union = lambda name: F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))).alias(name)
    # A row for each block at most.
    found = met.groupBy("_id").agg(F.max("n_words").alias("n_words"), union("hit_words"), union("items"))
    found = found.select("_id", F.struct("n_words", "hit_words", "items").alias("_found"))
    return rows.join(found, "_id").drop("_id")


def find_benchmark(
    documents: DataFrame,
    benchmark: DataFrame,
    block_bytes: int = BLOCK_BYTES,
    spans: bool = False,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The rows with n_words, hit_words (indexes, ascending) and items (ascending).

    With ``spans``, also ``hit_spans``: (start, end) offsets of the hit passages in the text itself. Columns of these
    names, in whatever case, are replaced.
    """
    items = settle(benchmark.select(F.col("item_id").cast("bigint"), "text").dropna().distinct(), "benchmark")
    rows = set_apart(documents, "text")
    if (items.agg(F.sum(F.length("text"))).first()[0] or 0) <= block_bytes:
        own = sorted((row["item_id"], row["text"]) for row in items.collect())  # block_bytes at most
        found = rows.withColumn("_found", scanned(F.col("text"), tuple(own)))
    else:
        found = in_blocks(rows, items, block_bytes, part_bytes)
    made = {name: F.col("_found")[name] for name in ("n_words", "hit_words", "items")}
    if spans:
        made["hit_spans"] = with_spans(F.col("text"), F.col("_found")["hit_words"])
    return put_back(found, documents, ["text"], made)


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_benchmark(documents.select(F.col("doc_id").cast("bigint"), "text"), benchmark)
    names = F.array_join(F.array_sort(F.transform("items", lambda item: item.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )
