"""Languages by the nearest of several centroids per language.

A text becomes a vector of hashed byte 2- and 3-grams of its lower-cased letters, weighted by
``(1 + ln tf) * idf`` and normalised. The documents of a language are clustered by spherical
k-means; a text gets the language of the centroid with the greatest cosine. It is rejected if that
cosine is below the centroid's radius, which is set from the documents it was made of.

The document frequencies cover all training rows; the clusters are fitted on at most
``sample_per_language`` rows of each language, those with the smallest hashes of their ids. A text
that is null or without a letter is ``und`` with score 0, and so is every text if nothing could be
learned. Repeated rows are judged alike; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchledger.llm.common import remainder, texts_of

DIMENSIONS = 4096
CENTROIDS = 4
SAMPLE_PER_LANGUAGE = 800
#: The model is one matrix in every worker, so the number of languages is bounded.
MAX_LANGUAGES = 1000
ROUNDS = 12
#: Texts and bytes whose grams are counted together.
CHUNK_TEXTS, CHUNK_BYTES = 128, 2_000_000
LETTER = regex.compile(r"\p{L}")
#: ASCII other than letters becomes a space.
LETTERS_ONLY = bytes(byte if byte >= 0x80 or chr(byte).isalpha() else 32 for byte in range(256))


def gram_counts(texts: list[str]) -> Iterator[np.ndarray]:
    """Rows of counts of hashed grams, for the texts in order, in blocks."""
    rows, pieces, size = 0, [], 0
    carried = np.zeros(DIMENSIONS, np.int64)

    def counted() -> np.ndarray:
        data = np.frombuffer(b"\n".join(pieces) + b"\n\n", np.uint8)
        place = np.cumsum(data == 10)
        wide = data.astype(np.uint32)
        two = wide[:-2] | wide[1:-1] << 8
        three = two | wide[2:] << 16
        ends = data == 10
        bins = []
        for grams, broken in ((two | 1 << 25, ends[:-2] | ends[1:-1]), (three, ends[:-2] | ends[1:-1] | ends[2:])):
            hashed = (grams * np.uint32(2654435761)) >> np.uint32(20)
            bins.append((place[:-2] * DIMENSIONS + hashed)[~broken])
        flat = np.bincount(np.concatenate(bins), minlength=len(pieces) * DIMENSIONS)
        return flat[: len(pieces) * DIMENSIONS].reshape(len(pieces), DIMENSIONS)

    for text in texts:
        data = b" %b " % b" ".join(text.lower().encode("utf-8").translate(LETTERS_ONLY).split())
        # A long text is counted in pieces, the last bytes of each again with the next.
        while len(data) > CHUNK_BYTES:
            block, pieces = pieces, [data[:CHUNK_BYTES]]
            carried += counted()[0]
            pieces, data = block, data[CHUNK_BYTES - 2 :]
            # The pair at the cut stands in both pieces.
            carried[((data[0] | data[1] << 8 | 1 << 25) * 2654435761 % 2**32) >> 20] -= 1
        pieces.append(data)
        size += len(data)
        rows += 1
        if carried.any() or rows == CHUNK_TEXTS or size > CHUNK_BYTES:
            block = counted()
            block[-1] += carried
            yield block
            rows, pieces, size = 0, [], 0
            carried = np.zeros(DIMENSIONS, np.int64)
    if pieces:
        yield counted()


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    return weights / np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    centroids: np.ndarray
    radii: np.ndarray
    idf: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        found, scores, rejected = [], [], []
        at = 0
        for counts in gram_counts(texts):
            block = texts[at : at + len(counts)]
            at += len(counts)
            if not self.languages:
                best, cosine = np.zeros(len(block), int), np.zeros(len(block))
            else:
                similar = vectors(counts, self.idf) @ self.centroids.T
                best = similar.argmax(axis=1)
                cosine = np.clip(similar[np.arange(len(block)), best], 0, 1)
            for text, place, score in zip(block, best, cosine, strict=True):
                known = bool(self.languages) and LETTER.search(text) is not None
                found.append(self.languages[place] if known else "und")
                scores.append(float(score) if known else 0.0)
                rejected.append(not known or bool(score < self.radii[place]))
        return found, scores, rejected


def clustered(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of spherical k-means from far apart starts, and the radius of each."""
    middle = points.mean(axis=0)
    chosen = [int((points @ middle).argmax())]
    for _ in range(min(CENTROIDS, len(points)) - 1):
        chosen.append(int((points @ points[chosen].T).max(axis=1).argmin()))
    centroids = points[chosen]
    for _ in range(ROUNDS):
        own = (points @ centroids.T).argmax(axis=1)
        sums = np.stack([points[own == k].sum(axis=0) if (own == k).any() else centroids[k] for k in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    similar = points @ centroids.T
    own, best = similar.argmax(axis=1), similar.max(axis=1)
    # Three quarters of the cosine that all but a hundredth of the members reach.
    radii = [0.75 * np.quantile(best[own == k], 0.01) if (own == k).any() else 0.0 for k in range(len(centroids))]
    return centroids, np.array(radii)


def fit(rows: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """``rows``: doc_id, text, lang of the training documents."""
    rows = rows.filter(F.col("lang").isNotNull())
    sizes = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"More than {MAX_LANGUAGES} languages")
    if not sizes:
        return Model([], np.zeros((0, DIMENSIONS), np.float32), np.zeros(0), np.ones(DIMENSIONS, np.float32))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Bucket DIMENSIONS holds the number of documents.
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in batches:
            for counts in gram_counts(texts_of(batch, "text")):
                total[:-1] += (counts > 0).sum(axis=0)
                total[-1] += len(counts)
        yield pa.record_batch([pa.array(range(DIMENSIONS + 1), pa.int32()), pa.array(total)], names=["bucket", "n"])

    found = rows.select("text").mapInArrow(frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(DIMENSIONS + 1)
    for row in found.collect():  # DIMENSIONS + 1 rows
        total[row["bucket"]] = row["n"]
    idf = (np.log((1 + total[-1]) / (1 + total[:-1])) + 1).astype(np.float32)

    # About twice as many rows as wanted by hash, then exactly the first ones.
    chance = rows.sparkSession.createDataFrame(
        [(lang, min(1.0, 2 * sample_per_language / size)) for lang, size in sizes.items()], "lang string, chance double"
    )
    draw = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")
    sample = (
        rows.withColumn("draw", F.pmod(draw, F.lit(1 << 30)))
        .join(F.broadcast(chance), "lang")
        .filter(F.col("draw") < F.col("chance") * (1 << 30))
    )

    def vectorised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for counts in gram_counts(texts_of(batch, "text")):
                data = [row.tobytes() for row in vectors(counts, idf)]
                own = batch.slice(at, len(counts))
                at += len(counts)
                yield pa.record_batch(
                    [own.column("lang"), own.column("draw"), own.column("doc_id"), pa.array(data, pa.binary())],
                    names=["lang", "draw", "doc_id", "vector"],
                )

    def cluster(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        points = np.stack([np.frombuffer(row, np.float32) for row in group.sort_values(["draw", "doc_id"])["vector"]])
        centroids, radii = clustered(points)
        return pd.DataFrame(
            {"lang": key[0], "number": range(len(radii)), "radius": radii, "centroid": [row.astype(np.float32).tobytes() for row in centroids]}
        )

    made = (
        sample.select("lang", "draw", "doc_id", "text")
        .mapInArrow(vectorised, "lang string, draw bigint, doc_id bigint, vector binary")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= sample_per_language)
        .groupBy("lang")
        .applyInPandas(cluster, "lang string, number int, radius double, centroid binary")
        .orderBy("lang", "number")
        .collect()  # a few rows per language
    )
    return Model(
        [row["lang"] for row in made],
        np.stack([np.frombuffer(row["centroid"], np.float32) for row in made]),
        np.array([row["radius"] for row in made]),
        idf,
    )


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected; a rejected text keeps the nearest language in ``lang_pred``."""

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores, rejected = model.predict(texts_of(batch, "text"))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(found, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        predicted, "doc_id bigint, lang_pred string, score double, rejected boolean"
    )


def held_out_languages(documents: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out and predict all."""
    documents = documents.select(F.col("doc_id").cast("bigint"), "text", "lang")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = fit(documents.filter(~held_out))
    return identify(documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
