"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text's shingles are its runs of five words (A-Z lower-cased; a text of fewer words is one shingle).
A shingle weighs its count times the inverse document frequency of its hash bucket, where equal texts (as
words) are one document, so that copies do not make their own shingles light. Each of
``BANDS * ROWS`` samples picks one shingle and a level of its weight, such that two texts pick the same
with a chance equal to their weighted Jaccard similarity. Samples are banded; texts that share a band
are candidates, and only those whose exact weighted Jaccard similarity reaches the threshold are linked.
A class is a connected component of links; its id is its least doc_id.

Equal texts (as words) are one representative from the start, so copies cost nothing further. Texts of a
band's bucket are compared with its leader (its least id) first, which joins most of them. Where a
bucket still holds several classes, its texts are cut into blocks of bounded size, by class, each two blocks
of different classes meet in one task, and that compares exactly all texts of different classes. It returns
no pairs but links that join classes. So every two texts that share a band are compared or in one class.

Null and empty texts, and texts without words, are classes of their own; so are rows without doc_id,
with a null class. Rows that repeat a doc_id are one document; if their texts differ, that with the least
hash counts. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchledger.llm.common import LOWER_AZ, mix, slices, texts_of
from benchledger.session import settle

SHINGLE = 5
THRESHOLD = 0.8
#: A pair at the threshold shares a band with a chance of 1 - (1 - 0.8 ** 4) ** 10 = 0.995.
BANDS, ROWS = 10, 4
#: Document frequencies are kept for hash buckets, as one array in every worker (4 MB).
BUCKET_BITS = 20
SEGMENTS = 64
#: Share of the texts added to all frequencies: what many near copies hold in common stays heavy enough.
SMOOTHING = 0.1
#: Shingles that are sampled together.
CHUNK = 32_768
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
#: Texts and bytes of a block of a bucket, on average.
BLOCK_TEXTS, BLOCK_BYTES = 128, 4_000_000
#: Shingles of a block pair that are compared together.
COMPARED = 16_384
#: Longer texts are not kept at hand.
REMEMBERED_LENGTH = 20_000


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(LOWER_AZ).split()


def shingles_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different shingles, ascending, and how often each stands in the text."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    if not size:
        return hashes, np.zeros(0, np.int64)
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for place in range(size):
        total += hashes[place : place + count] * FACTORS[place]
    return np.unique(mix(total, 0), return_counts=True)


@lru_cache(maxsize=1024)
def _remembered(text: str) -> tuple[np.ndarray, np.ndarray]:
    return shingles_of(words_of(text))


def shingles_in(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a text; of the texts that a worker saw last, unless they are long, they are at hand."""
    return _remembered(text) if len(text) < REMEMBERED_LENGTH else shingles_of(words_of(text))


def weights_of(shingles: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return counts * idf[shingles >> np.uint64(64 - BUCKET_BITS)]


def weighted_jaccard(one: str, other: str, idf: np.ndarray) -> float:
    """Similarity of two texts; 0 if either has no words."""
    a, a_counts = shingles_in(one)
    b, b_counts = shingles_in(other)
    if not len(a) or not len(b):
        return 0.0
    a_weights, b_weights = weights_of(a, a_counts, idf), weights_of(b, b_counts, idf)
    _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = float(np.minimum(a_weights[in_a], b_weights[in_b]).sum())
    return shared / (float(a_weights.sum()) + float(b_weights.sum()) - shared)


def gamma_quantiles() -> np.ndarray:
    """Gamma(2, 1) at the middles of 65,536 equal parts of probability."""
    chance = (np.arange(65_536) + 0.5) / 65_536
    low, high = np.zeros(65_536), np.full(65_536, 64.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < chance
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return ((low + high) / 2).astype(np.float32)


GAMMA = gamma_quantiles()


def sampled(shingles: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(texts, BANDS * ROWS) samples; text i has the shingles from ``starts[i]`` on.

    For shingle k and sample j: r, c ~ Gamma(2, 1) and b ~ U(0, 1) by hashing (k, j);
    t = floor(ln w / r + b); the sample is (k, t) of the least ln a = ln c - r * (t - b + 1).
    """
    log_weights = np.log(weights).astype(np.float32)
    sizes = np.diff(np.append(starts, len(shingles)))
    out = np.empty((len(starts), BANDS * ROWS), np.uint64)
    half, one = np.float32(0.5), np.float32(1)
    for number in range(BANDS * ROWS):
        # Four numbers of 16 bits: r by its quantile, b, and two uniform numbers whose product gives c.
        lanes = mix(shingles, number + 1).view(np.uint16).reshape(-1, 4)
        r = GAMMA.take(lanes[:, 0])
        b = lanes[:, 1] * np.float32(2**-16)
        log_a = lanes[:, 2] + half
        log_a *= lanes[:, 3] + half
        log_a *= np.float32(2**-32)
        np.log(log_a, out=log_a)
        np.negative(log_a, out=log_a)
        np.log(log_a, out=log_a)
        t = log_weights / r
        t += b
        np.floor(t, out=t)
        b -= t
        b -= one
        b *= r
        log_a += b
        least = np.minimum.reduceat(log_a, starts)
        places = np.flatnonzero(log_a == np.repeat(least, sizes))
        first = places[np.searchsorted(places, starts)]
        out[:, number] = mix(shingles[first] + t[first].astype(np.int64).view(np.uint64) * FACTORS[0], number)
    return out


def bands_of(texts: list[list[bytes]], idf: np.ndarray) -> Iterator[np.ndarray]:
    """For each text with words, in order, its band keys as signed numbers."""
    found, size = [], 0

    def out() -> Iterator[np.ndarray]:
        starts = np.cumsum([0, *(len(shingles) for shingles, _ in found)])[:-1]
        samples = sampled(np.concatenate([s for s, _ in found]), np.concatenate([w for _, w in found]), starts)
        keys = np.zeros((len(found), BANDS), np.uint64)
        for row in range(ROWS):
            keys = mix(keys * FACTORS[1] + samples[:, row::ROWS], 100 + row)
        yield from keys.view(np.int64)

    for words in texts:
        if not words:
            continue
        shingles, counts = shingles_of(words)
        found.append((shingles, weights_of(shingles, counts, idf)))
        size += len(shingles)
        if size >= CHUNK:
            yield from out()
            found, size = [], 0
    if found:
        yield from out()


COUNTS = "segment int, counts binary, documents bigint"


def words_hash(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def inverse_frequencies(documents: DataFrame) -> np.ndarray:
    """The weight of each bucket, from the different texts that hold a shingle of it.

    All rows are counted, and of each group of equal texts one row is fetched again and taken off as often
    as the group has more than one, so texts without a copy are never moved.
    """
    buckets = 1 << BUCKET_BITS
    part = buckets // SEGMENTS

    def add(total: np.ndarray, words: list[bytes], times: int) -> None:
        shingles, _ = shingles_of(words)
        total[np.unique(shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)] += times

    def parts(total: np.ndarray, seen: int) -> list[pa.Array]:
        data = [zlib.compress(total[at : at + part].tobytes(), 1) for at in range(0, buckets, part)]
        return [pa.array(range(SEGMENTS), pa.int32()), pa.array(data, pa.binary()), pa.array([seen] * SEGMENTS, pa.int64())]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The counts by segment and, as segment -1, the hash of every row's words."""
        total, seen = np.zeros(buckets, np.int64), 0
        names = ["segment", "counts", "documents", "own_id", "text_hash"]
        for batch in slices(batches, "text"):
            texts = [words_of(text) for text in texts_of(batch, "text")]
            for words in texts:
                add(total, words, 1)
            seen += len(texts)
            same = [pa.array([-1] * len(texts), pa.int32()), pa.array(map(words_hash, texts), pa.binary()), pa.array([1] * len(texts), pa.int64())]
            yield pa.record_batch([*same, batch.column("own_id"), batch.column("text_hash")], names=names)
        if seen:
            none = pa.nulls(SEGMENTS, pa.int64())
            yield pa.record_batch([*parts(total, seen), none, none], names=names)

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What further copies have added, below 0."""
        total, seen = np.zeros(buckets, np.int64), 0
        for batch in slices(batches, "text"):
            for text, more in zip(texts_of(batch, "text"), batch.column("more").to_pylist(), strict=True):
                add(total, words_of(text), -more)
                seen -= more
        if seen:
            yield pa.record_batch(parts(total, seen), names=["segment", "counts", "documents"])

    def united(key: tuple, group: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, documents_seen = np.zeros(part, np.int64), 0
        for rows in group:
            for counts, seen in zip(rows["counts"], rows["documents"], strict=True):
                total += np.frombuffer(zlib.decompress(counts), np.int64)
                documents_seen += seen
        smooth = SMOOTHING * documents_seen
        values = 1 + np.log((documents_seen + smooth) / (total + smooth))
        yield pd.DataFrame({"segment": [key[0]], "idf": [values.astype(np.float32).tobytes()]})

    # The id only spreads the copies of a text, of which one is fetched.
    rows = documents.select(F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("own_id"), "text", F.xxhash64("text").alias("text_hash"))
    counts = settle(rows.mapInArrow(counted, f"{COUNTS}, own_id bigint, text_hash bigint"), "near-counts")
    groups = (
        counts.filter("segment = -1")
        .groupBy("counts")
        .agg(F.max("own_id").alias("own_id"), F.max_by("text_hash", "own_id").alias("text_hash"), (F.count("*") - 1).alias("more"))
        .filter("more > 0")
        .select("own_id", "text_hash", "more")
    )
    groups = settle(groups, "near-equal").filter("more > 0")
    with filtered_early(documents):
        again = rows.join(groups, ["own_id", "text_hash"]).groupBy("text_hash").agg(F.min("text").alias("text"), F.min("more").alias("more"))
        less = again.select("text", "more").mapInArrow(copied, COUNTS)
        found = (
            counts.filter("segment >= 0")
            .select("segment", "counts", "documents")
            .union(less)
            .groupBy("segment")
            .applyInPandas(united, "segment int, idf binary")
            .collect()  # SEGMENTS rows, 4 MB
        )
    idf = np.ones(buckets, np.float32)
    for row in found:
        idf[row["segment"] * part : (row["segment"] + 1) * part] = np.frombuffer(row["idf"], np.float32)
    return idf


def signed(documents: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, words_hash (null without words) and bands of every document with an id."""

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [words_of(text) for text in texts_of(batch, "text")]
            keys = bands_of(texts, idf)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([words_hash(words) if words else None for words in texts], pa.binary()),
                    pa.array([next(keys) if words else None for words in texts], pa.list_(pa.int64())),
                    batch.column("text_hash"),
                ],
                names=["doc_id", "words_hash", "bands", "text_hash"],
            )

    rows = documents.filter(F.col("doc_id").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    made = rows.mapInArrow(signatures, "doc_id bigint, words_hash binary, bands array<bigint>, text_hash bigint")
    return made.groupBy("doc_id").agg(F.min(F.struct("text_hash", "words_hash", "bands")).alias("own")).select(
        "doc_id", "own.words_hash", "own.bands"
    )


def components(links: DataFrame) -> DataFrame:
    """node, class_id (the least node that is connected) for every node of ``links`` (a, b).

    In each round a node takes the least label among its own and its neighbours', and then that label's
    label; depth shrinks at least by half.
    """
    both = settle(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("class_id")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("class_id").alias("least"))
        stepped = labels.join(near, "node").select("node", F.least("class_id", "least").alias("class_id"), F.col("class_id").alias("was"))
        stepped = settle(stepped, "labels")
        further = stepped.select(F.col("node").alias("class_id"), F.col("class_id").alias("next"))
        labels = stepped.join(further, "class_id", "left").select(
            "node", F.coalesce("next", "class_id").alias("class_id"), "was"
        )
        labels = settle(labels, "labels")
        changed = labels.filter(F.col("class_id") != F.col("was")).limit(1).count()
        labels = labels.select("node", "class_id")
        if not changed:
            return labels


def joining(texts: list[str], classes: np.ndarray, idf: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Places of similar texts of different classes: links that join the classes, and no more than needed."""
    made = [shingles_in(text) for text in texts]
    # A shingle that stands n times is n items, so that common weight is a sum over common items.
    sizes = [int(counts.sum()) for _, counts in made]
    shingles = np.concatenate([np.repeat(own, counts) for own, counts in made])
    times = np.concatenate([counts for _, counts in made])
    copies = np.arange(len(shingles)) - np.repeat(np.cumsum(times) - times, times)
    rows = np.repeat(np.arange(len(texts)), sizes)
    items, own = np.unique(mix(shingles + copies.astype(np.uint64) * FACTORS[2], 5), return_inverse=True)
    weight = idf[shingles >> np.uint64(64 - BUCKET_BITS)].astype(np.float64)
    total = np.bincount(rows, weight, len(texts))
    often = np.bincount(own, minlength=len(items)) > 1
    number = np.cumsum(often) - 1
    there = often[own]
    rows, own, weight = rows[there], number[own[there]], weight[there]
    shared = np.zeros((len(texts), len(texts)), np.float32)
    order = np.argsort(own, kind="stable")
    rows, own, weight = rows[order], own[order], weight[order]
    for first in range(0, int(often.sum()), COMPARED):
        a, b = np.searchsorted(own, [first, first + COMPARED])
        held = np.zeros((len(texts), min(COMPARED, int(often.sum()) - first)), np.float32)
        held[rows[a:b], own[a:b] - first] = np.sqrt(weight[a:b])
        shared += held @ held.T
    similar = shared / np.maximum(total[:, None] + total[None, :] - shared, 1e-300)
    # The sums are rounded; what comes near is compared again.
    found = np.argwhere(np.triu(similar >= threshold - 1e-3, 1) & (classes[:, None] != classes[None, :]))
    label = {class_: class_ for class_ in classes.tolist()}

    def root(class_: int) -> int:
        while label[class_] != class_:
            class_ = label[class_]
        return class_

    links = []
    for a, b in found.tolist():
        one, other = root(int(classes[a])), root(int(classes[b]))
        if one != other and weighted_jaccard(texts[a], texts[b], idf) >= threshold:
            label[max(one, other)] = min(one, other)
            links.append((a, b))
    return links


BUCKET = ["band", "key"]


def linked(signatures: DataFrame, documents: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """a, b of links that join the representatives into classes; ``signatures``: doc_id, bands."""
    rows = signatures.select("doc_id", F.posexplode("bands").alias("band", "key"))
    leaders = rows.groupBy(*BUCKET).agg(F.min("doc_id").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    pool = settle(rows.join(leaders, BUCKET), "near-pool")
    texts = texts_of_ids(documents, pool.groupBy("doc_id").agg(F.max("n").alias("n")))

    sized = texts.select("doc_id", F.octet_length("text").alias("bytes"))

    # A leader meets its texts in parts of bounded size; in a part, all texts are compared.
    led = pool.filter("leader <> doc_id").select("leader", "doc_id").distinct()
    parts = led.join(sized, "doc_id").groupBy("leader").agg(blocks_for("doc_id", "bytes").alias("parts"))
    members = led.join(parts, "leader").select("leader", "doc_id", F.pmod(F.xxhash64("doc_id"), "parts").cast("int").alias("part"))
    themselves = parts.select("leader", F.col("leader").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    met = members.union(themselves).withColumn("class_id", F.col("doc_id"))
    with_leaders = settle(links_of(met, ["leader", "part"], texts, idf, threshold), "near-links")
    classes = components(with_leaders).withColumnRenamed("node", "doc_id")

    # Buckets that hold several classes still.
    placed = settle(
        pool.join(classes, "doc_id", "left")
        .join(sized, "doc_id")
        .select(*BUCKET, "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "bytes"),
        "near-placed",
    )
    open_ = (
        placed.groupBy(*BUCKET)
        .agg(blocks_for("doc_id", "bytes").alias("blocks"), F.min("class_id").alias("least"), F.max("class_id").alias("greatest"))
        .filter("least <> greatest")
        .select(*BUCKET, "blocks")
    )
    left = settle(placed.join(open_, BUCKET), "near-open")
    one = left.filter("blocks = 1").select(*BUCKET, F.lit(0).cast("bigint").alias("pair"), "doc_id", "class_id")
    met = one.unionByName(paired(left.filter("blocks > 1")))
    return with_leaders.unionByName(links_of(met, [*BUCKET, "pair"], texts, idf, threshold))


def blocks_for(texts: str, size: str) -> Column:
    """How many blocks a group's texts need."""
    return F.greatest(F.ceil(F.count(texts) / BLOCK_TEXTS), F.ceil(F.sum(size) / BLOCK_BYTES)).cast("int")


def paired(rows: DataFrame) -> DataFrame:
    """The rows of large buckets (with class_id and bytes) once for each ``pair`` of blocks in which they meet others.

    A class that fills a block has blocks of its own, smaller classes share some. Each two blocks of a bucket
    meet, and each shared one meets itself; but no two blocks of one class do, as its texts need not be compared.
    So a large class costs its size for each other block, and not its square.
    """
    sizes = rows.groupBy(*BUCKET, "class_id").agg(blocks_for("doc_id", "bytes").alias("own"), F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    alone = (F.col("n") >= BLOCK_TEXTS) | (F.col("bytes") >= BLOCK_BYTES)
    sizes = settle(sizes.withColumn("owner", F.when(alone, F.col("class_id"))), "near-sizes")
    few = sizes.filter("owner is null").groupBy(*BUCKET).agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_TEXTS), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("shared")
    )
    sizes = sizes.join(few, BUCKET, "left")
    # The blocks of a bucket: owned ones by class and number, shared ones by number.
    owned = sizes.filter("owner is not null").select(*BUCKET, "owner", F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("number"))
    shared = few.select(*BUCKET, F.lit(None).cast("bigint").alias("owner"), F.explode(F.sequence(F.lit(0), F.col("shared") - 1)).alias("number"))
    blocks = owned.unionByName(shared).withColumn("block", F.xxhash64(F.col("owner").isNull(), F.coalesce("owner", F.lit(0)), "number"))
    blocks = settle(blocks, "near-blocks")
    other = blocks.select(*BUCKET, F.col("owner").alias("other_owner"), F.col("block").alias("other"))
    meeting = blocks.join(other, BUCKET).filter(
        (F.col("block") <= F.col("other")) & ~F.coalesce(F.col("owner") == F.col("other_owner"), F.lit(False))
    )
    meeting = meeting.withColumn("pair", F.xxhash64("block", "other"))
    both = F.explode(F.array_distinct(F.array("block", "other")))
    meeting = meeting.select(*BUCKET, "pair", both.alias("block"))
    number = F.when(F.col("owner").isNull(), F.pmod(F.xxhash64("class_id"), F.col("shared"))).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("own")))
    placed = rows.drop("blocks", "bytes").join(sizes.select(*BUCKET, "class_id", "owner", "own", "shared"), [*BUCKET, "class_id"])
    placed = placed.withColumn("block", F.xxhash64(F.col("owner").isNull(), F.coalesce("owner", F.lit(0)), number.cast("int")))
    return placed.join(meeting, [*BUCKET, "block"]).select(*BUCKET, F.col("pair"), "doc_id", "class_id")


@contextmanager
def filtered_early(documents: DataFrame) -> Iterator[None]:
    """Spark's own runtime filter (a Bloom filter of the keys) keeps other documents out of the shuffle of a join.

    It is on by default for scans of 10 GB and more; here it is wanted whatever the scan.
    """
    conf, setting = documents.sparkSession.conf, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = conf.get(setting, None)
    conf.set(setting, "0")
    try:
        yield
    finally:
        if before is None:
            conf.unset(setting)
        else:
            conf.set(setting, before)


def texts_of_ids(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, text of the documents in ``ids`` (doc_id, n > 1), written."""
    ids = settle(ids, "near-ids").filter("n > 1").select("doc_id")
    with filtered_early(documents):
        found = documents.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi")
        return settle(found.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "near-texts")


def links_of(met: DataFrame, group: list[str], texts: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """a, b: links between the classes of each group; ``met``: the group's columns, doc_id, class_id."""

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        ids, classes = rows["doc_id"].to_numpy(), rows["class_id"].to_numpy()
        links = joining(rows["text"].tolist(), classes, idf, threshold) if len(set(classes.tolist())) > 1 else []
        return pd.DataFrame({"a": [ids[a] for a, _ in links], "b": [ids[b] for _, b in links]}, dtype="int64")

    return met.join(texts, "doc_id").groupBy(*group).applyInPandas(compared, "a bigint, b bigint")


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and class_id of every document."""
    documents = documents.select(F.col("doc_id").cast("bigint"), "text")
    idf = inverse_frequencies(documents)
    signatures = settle(signed(documents, idf), "near-signatures")
    # Of equal texts, the least id goes on.
    copies = signatures.filter(F.col("words_hash").isNotNull()).groupBy("words_hash").agg(
        F.min(F.struct("doc_id", "bands")).alias("first")
    )
    copies = settle(copies.select("words_hash", "first.doc_id", "first.bands"), "near-copies")
    classes = components(linked(copies.select("doc_id", "bands"), documents, idf, threshold))
    first = copies.select("words_hash", F.col("doc_id").alias("first_id"))
    found = F.coalesce("class_id", "first_id", "doc_id")
    named = (
        signatures.select("doc_id", "words_hash")
        .join(first, "words_hash", "left")
        .join(classes.withColumnRenamed("node", "first_id"), "first_id", "left")
        .select("doc_id", found.alias("class_id"))
    )
    unnamed = documents.filter(F.col("doc_id").isNull()).select("doc_id", F.lit(None).cast("bigint").alias("class_id"))
    return named.union(unnamed)
