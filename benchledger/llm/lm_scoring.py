"""Language-model scores from a log-frequency Bloom filter.

Tokens are the words of a text (runs of anything but space and ``\\x09-\\x0D``, with A-Z lower-cased) and
one end. The counts of words and word pairs in the training documents are quantised to levels,
1 + floor(log2 count), and a filter holds every level of an n-gram from 1 to its own. Probing level after
level until one is missing gives the level back; it is never too low, and rarely too high. A token's
probability interpolates the pair's relative frequency with the smoothed frequency of the word, both from
probes. The filter has parts by segments of the hash. While the counted tokens prove that all parts of the pair
filter are below ``FILTER_BYTES``, they are broadcast and the scoring tasks probe them; beyond it, no worker could
hold them, and each part is probed where it is made. The parts are the same, and so are all answers.

The base score takes exact word counts, which no worker could hold for a large corpus. So documents are
cut into blocks of tokens that are stored as places in the block's own list of word hashes. Lists are cut
into segments of the hash. Each segment counts its words and pairs over all blocks, makes its part of the
filter with 8 or more bits per entry, and counts of words and probed levels of both go back to the blocks.
A block costs one entry per different word or pair, a hot one an entry per block, and a row of the exchange
only for the segments that it has entries of, so rows never outnumber entries. The number of segments
follows the counted tokens.

A null text has the end as its only token. Without training documents all counts are 0. Pairs of any count
are in the filter, and no size of the input leaves one out. Pairs are told apart by 48 bits of their hash.
Repeated rows are counted and scored each on its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchledger.llm.common import LOWER_AZ, mix, remainder, texts_of
from benchledger.session import settle

#: Tokens of a block; a longer text is a block of its own.
BLOCK_TOKENS = 1_500_000
#: Least number of segments, and the most tokens per segment beyond it.
SEGMENTS = 512
SEGMENT_TOKENS = 1 << 22
#: The pair filter is broadcast if it cannot be larger.
FILTER_BYTES = 64_000_000
PROBES = 3
#: The smallest part of a filter has 2 ** 12 bits, if a bound allows.
SMALLEST_BITS = 12
#: Pairs of this count and more are in the filter: all.
LEAST_PAIRS = 1
PAIR_SHARE = 0.7
LEVELS = 40
#: The end of a text; no word contains a space.
END = np.uint64(xxhash.xxh64_intdigest(b" "))
PAIR = np.uint64(0x9E3779B97F4A7C15)
HIGH_48 = np.uint64(0xFFFFFFFFFFFF0000)
LEVEL = 0xC2B2AE3D27D4EB4F


def tokens_of(text: str) -> np.ndarray:
    words = text.encode("utf-8").translate(LOWER_AZ).split()
    tokens = np.empty(len(words) + 1, np.uint64)
    tokens[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    tokens[-1] = END
    return tokens


def pairs_of(tokens: np.ndarray) -> np.ndarray:
    """Hashes of each token after the one before it. Texts end with the end, so the first follows one."""
    before = np.concatenate([[END], tokens[:-1]])
    return mix(before * PAIR + tokens, 7) & HIGH_48


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    """Rises with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def ranges_of(ordered: np.ndarray, segments: int) -> list[tuple[int, int, int]]:
    """(segment, start, end) in ascending hashes of each segment that has some: as many as entries, at most."""
    own, starts = np.unique(segment_of(ordered, segments), return_index=True)
    ends = np.append(starts, len(ordered))[1:]
    return list(zip(own.tolist(), starts.tolist(), ends.tolist(), strict=True))


def summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes, ascending, with their counts added."""
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, int)
    return hashes[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def bits_of(hashes: np.ndarray, level: int, size_bits: np.ndarray | int) -> list[np.ndarray]:
    """Places of an entry in a part of ``2 ** size_bits`` bits."""
    own = mix(hashes + np.uint64(level * LEVEL & 0xFFFFFFFFFFFFFFFF), 11)
    mask = (np.uint64(1) << np.asarray(size_bits, np.uint64)) - np.uint64(1)
    step = (own >> np.uint64(32)) | np.uint64(1)
    return [(own + np.uint64(probe) * step) & mask for probe in range(PROBES)]


def filter_part(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """The filter of one segment: its bits, a power of two of bytes, 8 or more per entry."""
    levels = np.log2(np.maximum(counts, 1)).astype(np.int64) + 1
    size_bits = max(SMALLEST_BITS, (int(levels.sum()) * 8).bit_length())
    bits = np.zeros(1 << size_bits, np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for places in bits_of(hashes[levels >= level], level, size_bits):
            bits[places.astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


@dataclass(frozen=True)
class Filter:
    """The parts of all segments, one after the other."""

    segments: int
    data: np.ndarray
    starts: np.ndarray
    size_bits: np.ndarray

    @staticmethod
    def of(parts: dict[int, bytes], segments: int) -> Filter:
        found = [parts.get(segment, b"\0") for segment in range(segments)]
        sizes = np.array([len(part) for part in found], np.int64)
        return Filter(
            segments,
            np.frombuffer(b"".join(found), np.uint8),
            np.cumsum(sizes) - sizes,
            np.log2(sizes * 8).astype(np.uint64),
        )

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The levels found, 0 if there is none."""
        level_found = np.zeros(len(hashes), np.int64)
        left = np.arange(len(hashes))
        segment = segment_of(hashes, self.segments)
        for level in range(1, LEVELS + 1):
            own = segment[left]
            there = np.ones(len(left), bool)
            for places in bits_of(hashes[left], level, self.size_bits[own]):
                places = places.astype(np.int64)
                there &= (self.data[self.starts[own] + (places >> 3)] >> (places & 7).astype(np.uint8)) & 1 == 1
            left = left[there]
            if not len(left):
                break
            level_found[left] = level
        return level_found

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Estimated counts."""
        return middle(self.levels(hashes))


def middle(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of each level, 0 for none."""
    return np.where(levels > 1, 1.5 * 2.0 ** (levels - 1.0) - 0.5, levels)


def packed(pairs: np.ndarray) -> bytes:
    """Ascending hashes of pairs as differences of six bytes, of which the low three do not compress."""
    planes = np.diff(pairs >> np.uint64(16), prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return planes[:3].tobytes() + zlib.compress(planes[3:6].tobytes(), 1)


def unpacked(data: bytes, size: int) -> np.ndarray:
    planes = np.zeros((8, size), np.uint8)
    planes[:3] = np.frombuffer(data, np.uint8, 3 * size).reshape(3, size)
    planes[3:6] = np.frombuffer(zlib.decompress(data[3 * size :]), np.uint8).reshape(3, size)
    return np.cumsum(planes.T.copy().view("<u8").ravel(), dtype=np.uint64) << np.uint64(16)


@dataclass(frozen=True)
class Model:
    n: int
    v: int

    def log_probabilities(self, listed: np.ndarray, places: np.ndarray, words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Of the tokens ``listed[places]``, by the levels of ``listed`` and of their different pairs."""
        word_counts = middle(words)
        _, own = np.unique(pairs_of(listed[places]), return_inverse=True)
        pair = middle(pairs)[own]
        # Every text ends with the end, so each block lists it.
        before = word_counts[np.concatenate([[np.searchsorted(listed, END)], places[:-1]])]
        alone = np.minimum(1.0, (word_counts[places] + 1) / (self.n + self.v + 1))
        follows = np.where(before > 0, np.minimum(1.0, pair / np.maximum(before, 1)), 0.0)
        return np.log10((1 - PAIR_SHARE) * alone + PAIR_SHARE * follows)


def in_blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[list[tuple], np.ndarray]]:
    """(values of the columns and the number of tokens, per text), all tokens of the block."""
    rows: list[tuple] = []
    made: list[np.ndarray] = []
    size = 0
    for batch in batches:
        values = [batch.column(name).to_pylist() for name in columns]
        for *row, text in zip(*values, texts_of(batch, "text"), strict=True):
            tokens = tokens_of(text)
            if rows and size + len(tokens) > BLOCK_TOKENS:
                yield rows, np.concatenate(made)
                rows, made, size = [], [], 0
            rows.append((*row, len(tokens)))
            made.append(tokens)
            size += len(tokens)
    if rows:
        yield rows, np.concatenate(made)


BLOCK = "block bigint, doc_id array<bigint>, held_out array<boolean>, sizes array<int>, places binary, listed binary, trained binary"


def blocks_of(documents: DataFrame) -> DataFrame:
    """One row per block: its documents, the word hashes ascending, their training counts, the tokens' places."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, (rows, tokens) in enumerate(in_blocks(batches, ["doc_id", "held_out"])):
            listed, places = np.unique(tokens, return_inverse=True)
            learns = np.repeat([not held for _, held, _ in rows], [size for *_, size in rows])
            trained = np.bincount(places[learns], minlength=len(listed)).astype(np.uint32)
            packed = [
                zlib.compress(places.astype(np.uint32).tobytes(), 1),
                listed.tobytes(),
                zlib.compress(trained.tobytes(), 1),
            ]
            yield pa.record_batch(
                [
                    pa.array([first + number], pa.int64()),
                    pa.array([[row[0] for row in rows]], pa.list_(pa.int64())),
                    pa.array([[row[1] for row in rows]], pa.list_(pa.bool_())),
                    pa.array([[row[2] for row in rows]], pa.list_(pa.int32())),
                    *(pa.array([data], pa.binary()) for data in packed),
                ],
                names=["block", "doc_id", "held_out", "sizes", "places", "listed", "trained"],
            )

    return settle(documents.select("doc_id", "held_out", "text").mapInArrow(cut, BLOCK), "lm-blocks")


def tokens_in(blocks: DataFrame) -> int:
    return blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda total, own: total + own))).first()[0] or 0


def segments_of(tokens: int) -> int:
    """The number of segments; it follows the tokens, so no setting of the session changes a result."""
    return max(SEGMENTS, -(-tokens // SEGMENT_TOKENS))


def most_filter_bytes(tokens: int, segments: int) -> int:
    """No pair filter is larger: a pair of count c has at most c levels, and a level 16 bits at most."""
    return 2 * tokens + segments * (1 << SMALLEST_BITS) // 8


def word_counts(blocks: DataFrame, segments: int) -> DataFrame:
    """Per block and segment the counts and levels of its words; in rows of block -1 each segment's sums."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("block", "listed", "trained"))
            for block, listed, trained in zip(*columns, strict=True):
                hashes = np.frombuffer(listed, np.uint64)
                counts = np.frombuffer(zlib.decompress(trained), np.uint32)
                ranges = ranges_of(hashes, segments)
                yield pa.record_batch(
                    [
                        pa.array([block] * len(ranges), pa.int64()),
                        pa.array([segment for segment, _, _ in ranges], pa.int32()),
                        pa.array([hashes[a:b].tobytes() for _, a, b in ranges], pa.binary()),
                        pa.array([zlib.compress(counts[a:b].tobytes(), 1) for _, a, b in ranges], pa.binary()),
                    ],
                    names=["block", "segment", "hashes", "counts"],
                )

    def answered(key: tuple, group: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks_, hashes, counts = [], [], []
        for rows in group:
            blocks_ += rows["block"].tolist()
            hashes += [np.frombuffer(data, np.uint64) for data in rows["hashes"]]
            counts += [np.frombuffer(zlib.decompress(data), np.uint32).astype(np.int64) for data in rows["counts"]]
        known, total = summed(np.concatenate(hashes), np.concatenate(counts))
        seen = total > 0
        part = filter_part(known[seen], total[seen])
        levels = Filter.of({0: part}, 1).levels(known).astype(np.uint8)
        found = [(-1, int(total.sum()), int(seen.sum()), b"", b"")]
        for block, own in zip(blocks_, hashes, strict=True):
            at = np.searchsorted(known, own)
            found.append((block, 0, 0, zlib.compress(total[at].tobytes(), 1), zlib.compress(levels[at].tobytes(), 1)))
        yield pd.DataFrame(found, columns=["block", "n", "v", "data", "levels"]).assign(segment=key[0])

    rows = blocks.mapInArrow(asked, "block bigint, segment int, hashes binary, counts binary")
    found = rows.groupBy("segment").applyInPandas(answered, "block bigint, n bigint, v bigint, data binary, levels binary, segment int")
    return settle(found, "lm-words")


def pairs_by_segment(blocks: DataFrame, segments: int) -> DataFrame:
    """Per block and segment its different pairs, ascending by hash, and their training counts."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                row = {name: batch.column(name)[place].as_py() for name in batch.schema.names}
                listed = np.frombuffer(row["listed"], np.uint64)
                places = np.frombuffer(zlib.decompress(row["places"]), np.uint32)
                hashes, own = np.unique(pairs_of(listed[places]), return_inverse=True)
                learns = np.repeat(~np.array(row["held_out"], bool), row["sizes"])
                trained = np.bincount(own[learns], minlength=len(hashes)).astype(np.uint32)
                ranges = ranges_of(hashes, segments)
                yield pa.record_batch(
                    [
                        pa.array([row["block"]] * len(ranges), pa.int64()),
                        pa.array([segment for segment, _, _ in ranges], pa.int32()),
                        pa.array([packed(hashes[a:b]) for _, a, b in ranges], pa.binary()),
                        pa.array([zlib.compress(trained[a:b].tobytes(), 1) for _, a, b in ranges], pa.binary()),
                    ],
                    names=["block", "segment", "hashes", "counts"],
                )

    rows = blocks.select("block", "held_out", "sizes", "places", "listed")
    return rows.mapInArrow(asked, "block bigint, segment int, hashes binary, counts binary")


def gathered_pairs(group: Iterator[pd.DataFrame]) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray]:
    """The blocks and their pairs, and all pairs of the segment with their counts."""
    blocks_, hashes, counts = [], [], []
    for rows in group:
        for block, data, trained in zip(rows["block"].tolist(), rows["hashes"], rows["counts"], strict=True):
            blocks_.append(block)
            counts.append(np.frombuffer(zlib.decompress(trained), np.uint32).astype(np.int64))
            hashes.append(unpacked(data, len(counts[-1])))
    return blocks_, hashes, *summed(np.concatenate(hashes), np.concatenate(counts))


def pair_filter(blocks: DataFrame, segments: int) -> Filter:
    """The whole filter, for a broadcast."""

    def part_of(key: tuple, group: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, _, known, total = gathered_pairs(group)
        learned = total >= LEAST_PAIRS
        yield pd.DataFrame({"segment": [key[0]], "part": [filter_part(known[learned], total[learned])]})

    parts = pairs_by_segment(blocks, segments).groupBy("segment").applyInPandas(part_of, "segment int, part binary")
    # most_filter_bytes at most
    return Filter.of({row["segment"]: bytes(row["part"]) for row in parts.toLocalIterator()}, segments)


def pair_levels(blocks: DataFrame, segments: int) -> DataFrame:
    """Per block and segment the levels of its different pairs, ascending by hash."""

    def answered(key: tuple, group: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks_, hashes, known, total = gathered_pairs(group)
        learned = total >= LEAST_PAIRS
        part = filter_part(known[learned], total[learned])
        levels = Filter.of({0: part}, 1).levels(known).astype(np.uint8)
        found = [zlib.compress(levels[np.searchsorted(known, own)].tobytes(), 1) for own in hashes]
        yield pd.DataFrame({"block": blocks_, "segment": key[0], "pairs": found})

    found = pairs_by_segment(blocks, segments).groupBy("segment").applyInPandas(answered, "block bigint, segment int, pairs binary")
    return settle(found, "lm-pairs")


def score(documents: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``documents``: doc_id, text, held_out (learns from the others). A row with scores for every row."""
    blocks = blocks_of(documents)
    tokens = tokens_in(blocks)
    segments = segments_of(tokens)
    words = word_counts(blocks, segments)
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    model = Model(n, v)
    shared = None
    none = F.lit(None).cast("binary")
    answers = words.filter(F.col("block") >= 0).select("block", "segment", "data", "levels", none.alias("pairs"))
    if most_filter_bytes(tokens, segments) <= filter_bytes:
        shared = documents.sparkSession.sparkContext.broadcast(pair_filter(blocks, segments))
    else:
        answers = answers.union(pair_levels(blocks, segments).select("block", "segment", none, none, "pairs"))
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("segment", "data", "levels", "pairs")).alias("answers"))
    rows = blocks.drop("trained").join(answers, "block")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm = np.log10(model.n + model.v + 1)
        for batch in batches:
            for place in range(batch.num_rows):
                row = {name: batch.column(name)[place].as_py() for name in batch.schema.names}
                listed = np.frombuffer(row["listed"], np.uint64)
                places = np.frombuffer(zlib.decompress(row["places"]), np.uint32).astype(np.int64)
                answers = sorted(row["answers"], key=lambda answer: answer["segment"])
                counts, levels, pairs = (
                    np.concatenate(
                        [np.zeros(0, kind), *(np.frombuffer(zlib.decompress(a[name]), kind) for a in answers if a[name] is not None)]
                    )
                    for name, kind in (("data", np.int64), ("levels", np.uint8), ("pairs", np.uint8))
                )
                if shared is not None:
                    pairs = shared.value.levels(np.unique(pairs_of(listed[places])))
                sizes = np.array(row["sizes"], np.int64)
                starts = np.cumsum(sizes) - sizes
                base = np.add.reduceat(np.log10(counts + 1.0)[places], starts) - sizes * norm
                known = np.add.reduceat((counts > 0).astype(np.int64)[places], starts)
                total = np.add.reduceat(model.log_probabilities(listed, places, levels, pairs), starts)
                yield pa.record_batch(
                    [
                        pa.array(row["doc_id"], pa.int64()),
                        pa.array(row["held_out"], pa.bool_()),
                        pa.array(sizes),
                        pa.array(known),
                        pa.array([model.n] * len(sizes), pa.int64()),
                        pa.array(base),
                        pa.array(total),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return rows.mapInArrow(
        scored,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )


def lm_scores(documents: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Scores of every document, learned from those that are not held out."""
    held_out = remainder(F.col("doc_id"), 7) == 2
    return score(documents.select(F.col("doc_id").cast("bigint"), "text").withColumn("held_out", held_out), filter_bytes)
