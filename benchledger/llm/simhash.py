"""Near duplicates by SimHash, found by the generalised pigeonhole principle.

A text's words (A-Z lower-cased) give its 3-word shingles, repeats included; a text of fewer words is one
shingle. Bit k of the 64-bit fingerprint is 1 if bit k is set in over half of the shingles' XXH64 hashes.
Texts without words have fingerprint 0. Fingerprints link at ``DISTANCE`` or fewer differing bits, and a
component is what links connect.

Search among the different fingerprints: the 64 bits are dealt into m parts, correlated bits into one. If
part i has the threshold t_i >= -1 and the thresholds add up to DISTANCE - m + 1, then two fingerprints within
DISTANCE bits have a part that differs in t_i bits at most (else they differ in DISTANCE - m + 1 + m bits or
more). So each fingerprint may choose its own thresholds, and no link is lost: a dynamic program gives it those
of the least cost, from the candidates that each part would give it at each threshold. These are estimated from
counts of all fingerprints: a part is seen as pieces of up to ``PIECE_BITS`` independent bits, whose values are
counted exactly. A fingerprint then holds one value per part and asks for all values within its thresholds;
where a value is held and asked for, it is a candidate, compared by XOR and bit count.

m follows from the number of fingerprints (fewer and wider parts for more), which changes work and not results.
A value's rows are cut into blocks of bounded size and each two blocks meet in one task, so a value that many
fingerprints share is spread. A task returns, for what its links connect, one row per fingerprint and no pairs.

Equal fingerprints are one from the start, so copies cost nothing further. Null and empty texts and texts
without words link like any other. Rows that repeat a doc_id are rows of their own. A row without doc_id has a
fingerprint and links others, but names no component; its component_id is null if no row of the component has an id.
Texts of any length are hashed whole, in slices. Other columns, whatever their names, are left out. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchledger.llm.common import LOWER_AZ, slices, texts_of
from benchledger.llm.near_duplicates import components
from benchledger.session import settle

BITS = 64
SHINGLE = 3
SEED = 42
#: Differing bits of linked fingerprints, at most.
DISTANCE = 2
#: Bits whose values are counted together; a table has 2 ** PIECE_BITS counts.
PIECE_BITS = 11
#: Shingles whose bits are counted together.
CHUNK = 65_536
#: Rows of a value that meet in one block, and pairs that a task holds.
BLOCK, PAIRS = 2_048, 1_000_000
#: Rows that a task emits at once.
EMITTED = 262_144
#: A value asked for costs as much as so many candidates.
ASKING = 4.0


def fingerprint(text: str) -> int:
    """Unsigned."""
    words = text.encode("utf-8").translate(LOWER_AZ).split()
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - size + 1].tolist()
    ends = (ends[size - 1 :] - 1).tolist()
    count = np.zeros(BITS, np.int64)
    for first in range(0, len(starts), CHUNK):
        some = zip(starts[first : first + CHUNK], ends[first : first + CHUNK], strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[start:end], SEED) for start, end in some], "<u8")
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * count > len(starts), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fingerprint (as a signed number) of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = np.array([fingerprint(text) for text in texts_of(batch, "text")], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fingerprint"])

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(hashed, f"doc_id {id_type}, fingerprint bigint")


def values_in(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64)


def bit_pairs(different: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and of those that have both bits of each two (a bit's own on the diagonal)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS), np.int64)
        seen = 0
        for batch in batches:
            values = values_in(batch, "fingerprint")
            seen += len(values)
            for first in range(0, len(values), CHUNK):
                some = values[first : first + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
                bits = np.unpackbits(some, axis=1, bitorder="little").astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
        if seen:
            n = np.append(both.ravel(), seen)
            yield pa.record_batch([pa.array(np.arange(len(n))), pa.array(n)], names=["pair", "n"])

    sums = different.mapInArrow(counted, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    n = np.zeros(BITS * BITS + 1, np.int64)
    for row in sums.collect():  # BITS * BITS + 1 rows
        n[row["pair"]] = row["n"]
    return int(n[-1]), n[:-1].reshape(BITS, BITS)


def grouped_bits(count: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The bits of each part. A part begins with the two most correlated bits left and takes what is most
    correlated with those that it has."""
    share = both / max(count, 1)
    own = np.diag(share)
    spread = np.sqrt(np.maximum(np.outer(own * (1 - own), own * (1 - own)), 1e-12))
    near = np.round(np.abs(share - np.outer(own, own)) / spread, 6)
    np.fill_diagonal(near, 0)
    left = list(range(BITS))
    groups = []
    for part in range(parts):
        size = (BITS - sum(map(len, groups))) // (parts - part)
        among = near[np.ix_(left, left)]
        first = left[int(np.argmax(among.max(axis=1)))]
        group = [first]
        left.remove(first)
        while len(group) < size:
            following = left[int(np.argmax(near[np.ix_(left, group)].sum(axis=1)))]
            group.append(following)
            left.remove(following)
        groups.append(sorted(group))
    return groups


def gathered(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each value, as a number."""
    out = np.zeros(len(values), np.uint64)
    for place, bit in enumerate(bits):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out


def pieces_of(bits: list[int]) -> list[list[int]]:
    count = -(-len(bits) // PIECE_BITS)
    return [bits[len(bits) * i // count : len(bits) * (i + 1) // count] for i in range(count)]


def asked(width: int, threshold: int) -> int:
    """How many values lie within the threshold."""
    return sum(comb(width, distance) for distance in range(threshold + 1))


def usual_parts(count: int, distance: int) -> int:
    """The number of parts with the least cost for evenly spread fingerprints and even thresholds."""

    def cost(parts: int) -> float:
        total, own = distance - parts + 1, 0.0
        for part in range(parts):
            threshold = -(-(total + part) // parts) if total >= 0 else (0 if part <= distance else -1)
            width = BITS // parts
            if threshold >= 0:
                own += asked(width, threshold) * (ASKING + count / 2**width)
        return own

    return min(range(1, distance + 2), key=cost)


class Costs:
    """The cost of each threshold in each part, for any fingerprints."""

    def __init__(self, count: int, groups: list[list[int]], seen: dict[tuple[int, int], np.ndarray], distance: int):
        self.groups, self.distance = groups, distance
        self.count = count
        self.tables = {}
        for key, values in seen.items():
            table = np.zeros((distance + 1, len(values)))
            at = np.arange(len(values))
            width = len(values).bit_length() - 1
            for off in range(distance + 1):
                for bits in combinations(range(width), off):
                    table[off] += values[at ^ sum(1 << bit for bit in bits)]
            self.tables[key] = table / max(count, 1)

    def of(self, values: np.ndarray, part: int) -> np.ndarray:
        """(thresholds from -1 on, fingerprints)."""
        bits = self.groups[part]
        chance = np.zeros((self.distance + 1, len(values)))
        chance[0] = 1
        for piece, own in enumerate(pieces_of(bits)):
            table = self.tables[part, piece][:, gathered(values, own).astype(np.int64)]
            chance = np.stack(
                [sum(chance[one] * table[off - one] for one in range(off + 1)) for off in range(self.distance + 1)]
            )
        made = self.count * np.cumsum(chance, axis=0)
        made += ASKING * np.array([[asked(len(bits), threshold)] for threshold in range(self.distance + 1)])
        return np.vstack([np.zeros(len(values)), made])

    def thresholds(self, values: np.ndarray) -> np.ndarray:
        """(parts, fingerprints): thresholds of the least cost that add up to distance - parts + 1.

        Counted from -1 they add up to distance + 1: what is spent on the parts so far, part by part.
        """
        whole = self.distance + 1
        best = np.full((whole + 1, len(values)), np.inf)
        best[0] = 0
        choices = []
        for part in range(len(self.groups)):
            costs = self.of(values, part)
            sums = np.full((whole + 1, whole + 1, len(values)), np.inf)
            for spent in range(whole + 1):
                for own in range(spent + 1):
                    sums[spent, own] = best[spent - own] + costs[own]
            choices.append(sums.argmin(axis=1))
            best = sums.min(axis=1)
        left = np.full(len(values), whole)
        out = np.zeros((len(self.groups), len(values)), np.int64)
        for part in reversed(range(len(self.groups))):
            own = choices[part][left, np.arange(len(values))]
            out[part] = own - 1
            left = left - own
        return out


def costs_of(different: DataFrame, distance: int, parts: int | None = None) -> Costs:
    """From all fingerprints; what comes to the driver is 4,097 numbers and the counts of the pieces."""
    count, both = bit_pairs(different)
    groups = grouped_bits(count, both, parts or usual_parts(count, distance))
    pieces = [(part, piece, own) for part, bits in enumerate(groups) for piece, own in enumerate(pieces_of(bits))]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(1 << len(own), np.int64) for *_, own in pieces]
        for batch in batches:
            values = values_in(batch, "fingerprint")
            for place, (*_, own) in enumerate(pieces):
                seen[place] += np.bincount(gathered(values, own).astype(np.int64), minlength=1 << len(own))
        for place, numbers in enumerate(seen):
            there = np.flatnonzero(numbers)
            columns = [np.full(len(there), place), there, numbers[there]]
            yield pa.record_batch([pa.array(column) for column in columns], names=["place", "value", "n"])

    sums = different.mapInArrow(counted, "place bigint, value bigint, n bigint").groupBy("place", "value").agg(F.sum("n").alias("n"))
    seen = {(part, piece): np.zeros(1 << len(own), np.int64) for part, piece, own in pieces}
    for row in sums.collect():  # 2 ** PIECE_BITS rows a piece at most
        seen[pieces[row["place"]][:2]][row["value"]] = row["n"]
    return Costs(count, groups, seen, distance)


def held_and_asked(different: DataFrame, costs: Costs) -> DataFrame:
    """part, value, fingerprint, holds (the value is its own), asks (the value is within its threshold)."""

    masks = [
        [
            np.array([sum(1 << bit for bit in bits) for bits in combinations(range(len(group)), off)], np.uint64)
            for off in range(costs.distance + 1)
        ]
        for group in costs.groups
    ]
    most = max(sum(len(off) for off in own) for own in masks)
    at_once = max(1, EMITTED // most)

    def rows_of(values: np.ndarray) -> Iterator[pa.RecordBatch]:
        thresholds = costs.thresholds(values)
        for part, group in enumerate(costs.groups):
            own = gathered(values, group)
            for off in range(costs.distance + 1):
                asking = thresholds[part] >= off
                if off == 0:
                    value, whose, asks = own, values, asking
                else:
                    value = (own[asking][:, None] ^ masks[part][off][None, :]).ravel()
                    whose = np.repeat(values[asking], len(masks[part][off]))
                    asks = np.ones(len(value), bool)
                if len(value):
                    yield pa.record_batch(
                        [
                            pa.array(np.full(len(value), part, np.int32)),
                            pa.array(value.view(np.int64)),
                            pa.array(whose.view(np.int64)),
                            pa.array(np.full(len(value), off == 0)),
                            pa.array(asks),
                        ],
                        names=["part", "value", "fingerprint", "holds", "asks"],
                    )

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = values_in(batch, "fingerprint")
            for first in range(0, len(values), at_once):
                yield from rows_of(values[first : first + at_once])

    return different.mapInArrow(emitted, "part int, value bigint, fingerprint bigint, holds boolean, asks boolean")


def united(one: np.ndarray, other: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Labels (the least place that is connected), after the pairs are linked, too."""
    while True:
        least = np.minimum(labels[one], labels[other])
        new = labels.copy()
        np.minimum.at(new, labels[one], least)
        np.minimum.at(new, labels[other], least)
        while (new != new[new]).any():
            new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def links_in(group: np.ndarray, values: np.ndarray, distance: int) -> np.ndarray:
    """For each row, the least place in its group that links within the distance connect it with.

    Rows of a group are neighbours. Row i meets row i + 1, i + 2, ... for as long as any are of one group.
    """
    labels = np.arange(len(values))
    place = np.flatnonzero(np.append(group[1:] == group[:-1], False))
    ones, others, held = [], [], 0
    step = 1
    while len(place):
        near = np.bitwise_count(values[place] ^ values[place + step]) <= distance
        ones.append(place[near])
        others.append(place[near] + step)
        held += len(ones[-1])
        if held > PAIRS:
            labels = united(np.concatenate(ones), np.concatenate(others), labels)
            ones, others, held = [], [], 0
        step += 1
        place = place[place + step < len(values)]
        place = place[group[place] == group[place + step]]
    return united(np.concatenate(ones), np.concatenate(others), labels) if held else labels


MET = ["part", "value", "low", "high"]


def links(rows: DataFrame, distance: int) -> DataFrame:
    """a, b: fingerprints such that they and the links have the same components; ``rows``: held_and_asked."""
    shared = (
        rows.groupBy("part", "value")
        .agg(F.count("*").alias("n"), F.bool_or("holds").alias("held"), F.bool_or("asks").alias("asked"))
        .filter("n > 1 and held and asked")
        .select("part", "value", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    meeting = (
        rows.join(shared, ["part", "value"])
        .select("part", "value", "fingerprint", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("part", "value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fingerprint")
    )
    together = meeting.repartition(*MET).sortWithinPartitions(*MET)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in batches:
            columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in (*MET, "fingerprint")]
            if kept is not None:
                columns = [np.concatenate(both) for both in zip(kept, columns, strict=True)]
            differing = np.zeros(len(columns[0]), bool)
            for column in columns[:-1]:
                differing[1:] |= column[1:] != column[:-1]
            borders = np.flatnonzero(differing)
            last = int(borders[-1]) if len(borders) else 0
            kept = [column[last:] for column in columns]  # it may go on in the next batch
            if last:
                yield from found(differing[:last], columns[-1][:last])
        if kept is not None:
            yield from found(np.zeros(len(kept[0]), bool), kept[-1])

    def found(differing: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        labels = links_in(np.cumsum(differing), values.view(np.uint64), distance)
        moved = np.flatnonzero((labels != np.arange(len(labels))) & (values[labels] != values))
        if len(moved):
            yield pa.record_batch([pa.array(values[labels[moved]]), pa.array(values[moved])], names=["a", "b"])

    return together.mapInArrow(linked, "a bigint, b bigint")


def simhash_components(documents: DataFrame, distance: int = DISTANCE, parts: int | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (the least doc_id) of every row.

    ``parts`` overrides the number of parts; results do not depend on it.
    """
    signed = settle(fingerprints(documents), "simhash-fingerprints")
    own = signed.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id"))
    different = settle(own, "simhash-different")
    costs = costs_of(different, distance, parts)
    rows = settle(held_and_asked(different.select("fingerprint"), costs), "simhash-values")
    classes = components(settle(links(rows, distance), "simhash-links")).withColumnRenamed("node", "fingerprint")
    linked = settle(different.join(classes, "fingerprint", "left"), "simhash-classes")
    first = linked.filter("class_id is not null").groupBy("class_id").agg(F.min("least_id").alias("first_id"))
    named = linked.join(first, "class_id", "left").select(
        "fingerprint", F.when(F.col("class_id").isNull(), F.col("least_id")).otherwise(F.col("first_id")).alias("component_id")
    )
    return signed.join(named, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
