"""Token counts of a byte-level BPE vocabulary by heap-and-linked-list merging.

A text is cut at the vocabulary's special strings and then by its pre-tokenising pattern. The bytes
of a piece form a linked list of symbols; a heap holds the adjacent pairs that the vocabulary can
merge, lowest rank first. Popping a pair joins two symbols and offers the new neighbours. The count
of a piece is its number of bytes minus the number of merges, so no token identifiers are made. A
piece of any length takes O(n log n).

Null and empty texts have no bytes and no tokens. Other columns of the input are not read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchledger.llm.common import texts_of

# Fixed value: the public pattern of byte-level BPE vocabularies of this family.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces whose count a worker remembers; beyond it the memory starts anew.
REMEMBERED = 400_000
#: Longer pieces are not remembered.
REMEMBERED_LENGTH = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary files: itself, else the next from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(byte) if byte in printable else chr(next(spare)) for byte in range(256)]


class BpeCounter(dict):
    """Counts tokens; as a dictionary it remembers the counts of pieces."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        known = {letter: byte for byte, letter in enumerate(byte_letters())}
        #: (left symbol, right symbol) as one number -> (rank, joined symbol)
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(described["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            joined = known.setdefault(left + right, len(known))
            self.pairs.setdefault(known[left] << 32 | known[right], (rank, joined))
        special = [token["content"] for token in described["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pieces = regex.compile(PIECES)

    def merged(self, data: bytes) -> int:
        """Symbols that are left of a piece."""
        symbols, size = list(data), len(data)
        if size < 2:
            return size
        pairs, push, pop = self.pairs.get, heapq.heappush, heapq.heappop
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        # An entry is (rank, place) in one number; it is stale when the pair at the place has another rank.
        heap = []
        for place in range(size - 1):
            found = pairs(symbols[place] << 32 | symbols[place + 1])
            if found:
                heap.append(found[0] << 32 | place)
        heapq.heapify(heap)
        left_over = size
        while heap:
            entry = pop(heap)
            place = entry & 0xFFFFFFFF
            own = symbols[place]
            right = after[place]
            if own < 0 or right >= size:
                continue
            found = pairs(own << 32 | symbols[right])
            if not found or found[0] != entry >> 32:
                continue
            symbols[place] = own = found[1]
            symbols[right] = -1
            after[place] = right = after[right]
            left_over -= 1
            if right < size:
                before[right] = place
                found = pairs(own << 32 | symbols[right])
                if found:
                    push(heap, found[0] << 32 | place)
            left = before[place]
            if left >= 0:
                found = pairs(symbols[left] << 32 | own)
                if found:
                    push(heap, found[0] << 32 | left)
        return left_over

    def __missing__(self, piece: str) -> int:
        count = self.merged(piece.encode("utf-8"))
        if len(piece) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = count
        return count

    def count(self, text: str) -> int:
        if self.special is None or self.special.search(text) is None:
            return sum(map(self.__getitem__, self.pieces.findall(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces.findall(part))) for part in parts)


@lru_cache(maxsize=4)
def counter(path: str) -> BpeCounter:
    """One for each Python worker and file."""
    return BpeCounter(path)


def count_tokens(documents: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every document.

    ``vocabulary`` is the path of the vocabulary file, at the same place on every machine.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(vocabulary)
        for batch in batches:
            texts = texts_of(batch, "text")
            tokens = [model.count(text) for text in texts]
            sizes = [len(text.encode("utf-8")) for text in texts]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    rows = documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        counted, "doc_id bigint, n_bytes bigint, n_tokens bigint"
    )
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
