"""Groups of spelling variants: words at an edit distance of one, found by pivotal grams.

All bigrams are ordered by how many words have them, the rarest first. The gram prefix of a word is its
three rarest bigrams with their places (and all others of the third one's kind). One edit spoils at most one
of two disjoint bigrams, and among three places two are always disjoint, so a dynamic program picks as pivots
those two disjoint bigrams of the prefix that fewest words have. If the words r and s differ by one edit
and the last kind in r's prefix is not after that in s's, then a pivot of r stands in s, and in s's prefix.

Position limits: all that an edit spares before it stands in s at the same distance from the beginning, and all
after it at the same distance from the end. So where the edit is, seen from the pivots A and B, says which pivot
to look for and what else is equal: before A (all from A on), in A (all from behind it on, B in it), between
them (all up to A and all from B on), in B, behind B. The index has each prefix gram with a few such surroundings,
each word asks once for each of the five cases, and what is found is verified by edit distance. Pairs are
brought together once, however often they are found.

A word's form is its near word that occurs most (of equals the first in code-point order), if that occurs at
least ``RATIO`` times as often as the word. The root is where forms lead to; as counts grow at each step, the chain
is short, and pointer doubling follows it in few rounds.

Words come from runs of letters, of which A-Z are lower-cased. Null and empty texts have none; a null doc_id counts
as an empty one. Texts of any length are read whole; repeated rows count again. Other columns, whatever their
names, are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchledger.llm.common import LOWER_AZ, slices, texts_of
from benchledger.session import settle

RUN = re.compile("[a-zÀ-ÿ]+")
#: Code points and occurrences of a word, at least.
LENGTH, OCCURRENCES = 5, 3
#: A form occurs so many times as often as the word.
RATIO = 2
GRAM, EDITS = 2, 1
#: Bigrams of a prefix, before others of the last one's kind.
PREFIX = GRAM * EDITS + 1
#: Of the runs of a document one in so many loses a code point.
DAMAGED = 97
#: Words that a task counts before it emits them.
HELD = 200_000


def damaged_word(run: str, doc_id: bytes, one_in: int) -> str:
    """The run, or without one of its code points; a hash of the document's id and the run decides."""
    h = zlib.crc32(run.encode("utf-8"), zlib.crc32(b":", zlib.crc32(doc_id)))
    if h % one_in:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1 :]


def word_counts(documents: DataFrame, length: int = LENGTH, damaged: int | None = None) -> DataFrame:
    """word, n of all words of at least ``length`` code points.

    With ``damaged``, one in so many different runs of a document loses a code point, to have misspellings.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text"), strict=True):
                runs = Counter(RUN.findall(text.encode("utf-8").translate(LOWER_AZ).decode("utf-8")))
                own = (doc_id or "").encode("utf-8")
                for run, n in runs.items():
                    if len(run) >= length:
                        word = damaged_word(run, own, damaged) if damaged else run
                        if len(word) >= length:
                            total[word] += n
                if len(total) >= HELD:
                    yield out()
                    total.clear()
        if total:
            yield out()

    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How many words have each bigram; there are no more than pairs of letters."""
    places = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    grams = F.transform(places, lambda place: F.substr(F.col("word"), place, F.lit(GRAM)))
    counts = words.select(F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram").count()
    return {row["gram"]: row["count"] for row in counts.collect()}  # at most the square of 90 letters


def prefix_of(word: str, order: dict[str, int]) -> list[tuple[int, int]]:
    """(order, place) of the grams of the prefix."""
    grams = sorted((order[word[place : place + GRAM]], place) for place in range(len(word) - GRAM + 1))
    limit = grams[PREFIX - 1][0]
    return [gram for gram in grams if gram[0] <= limit]


def pivots_of(prefix: list[tuple[int, int]], costs: list[int]) -> set[int]:
    """Places of EDITS + 1 disjoint grams of the least sum of costs; ``costs`` by order."""
    wanted = EDITS + 1
    grams = sorted((place, costs[number]) for number, place in prefix)
    # best[i][k]: cost and places of k disjoint grams among the first i.
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ()), *[None] * wanted]]
    for i, (place, cost) in enumerate(grams):
        free = i
        while free and grams[free - 1][0] > place - GRAM:
            free -= 1
        row = list(best[i])
        for k in range(1, wanted + 1):
            if (before := best[free][k - 1]) is not None:
                with_it = (before[0] + cost, (*before[1], place))
                row[k] = with_it if row[k] is None else min(row[k], with_it)
        best.append(row)
    return set(best[-1][wanted][1])


def index_keys(word: str, prefix: list[tuple[int, int]]) -> Iterator[str]:
    """Surroundings of the prefix grams: up to the gram or two letters on, from the gram or two letters
    before it, and up to or from it with the two letters at the word's other end."""
    for _, place in prefix:
        up_to, on = word[: place + GRAM], word[place:]
        yield f"{up_to}<"
        yield f"{word[: place + 2 * GRAM]}<"
        yield f"{up_to}|{word[-GRAM:]}"
        yield f">{on}"
        yield f">{word[max(place - GRAM, 0) :]}"
        yield f"{word[:GRAM]}|{on}"


def asked_keys(word: str, first: int, second: int) -> set[str]:
    """What is equal around a pivot in a word that an edit makes of this one, for each place of the edit."""
    keys = {f">{word[first:]}", f"{word[: second + GRAM]}<"}  # before the first pivot, behind the second
    keys.add(f"{word[:GRAM]}|{word[second:]}")  # between
    if second - first >= 2 * GRAM:  # in the first: equal from behind it; in the second: equal up to it
        return keys | {f">{word[second - GRAM :]}", f"{word[: first + 2 * GRAM]}<"}
    keys.add(f"{word[:GRAM]}|{word[second:]}" if first >= GRAM else f">{word[second:]}")
    keys.add(f"{word[: first + GRAM]}|{word[-GRAM:]}" if len(word) - second >= 2 * GRAM else f"{word[: first + GRAM]}<")
    return keys


def keyed(words: DataFrame, counts: dict[str, int], asking: bool) -> DataFrame:
    """key (a hash), word, n, last (order of the last gram kind): what words ask for, or the index."""
    kinds = sorted(counts, key=lambda gram: (counts[gram], gram))
    order = {gram: number for number, gram in enumerate(kinds)}
    costs = [counts[gram] for gram in kinds]

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                prefix = prefix_of(word, order)
                last = max(number for number, _ in prefix)
                keys = asked_keys(word, *sorted(pivots_of(prefix, costs))) if asking else set(index_keys(word, prefix))
                rows += [(key, word, n, last) for key in sorted(keys)]
            if rows:
                yield pa.record_batch([pa.array(column) for column in zip(*rows, strict=True)], names=["key", "word", "n", "last"])

    rows = words.mapInArrow(emitted, "key string, word string, n bigint, last bigint")
    return rows.withColumn("key", F.xxhash64("key"))


def unbroadcast(rows: DataFrame) -> DataFrame:
    """The rows for a join that shuffles and sorts both sides, whatever size Spark estimates.

    Its estimate is that of the compressed file of words, and knows neither how many keys a word emits nor how long
    words are; up to some size it would therefore collect tens of millions of keys in the driver, to broadcast them.
    """
    return rows.hint("merge")


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: every two words that differ by one edit, once, a before b."""
    short = F.assert_true(F.length("word") >= 2 * GRAM, F.lit("pivotal grams need words of four or more code points"))
    words = words.filter(short.isNull())
    counts = gram_counts(words)
    asked = keyed(words, counts, asking=True).select("key", *[F.col(name).alias(f"own_{name}") for name in ("word", "n", "last")])
    found = asked.join(unbroadcast(keyed(words, counts, asking=False)), "key").filter(
        (F.col("own_last") <= F.col("last")) & (F.levenshtein("own_word", "word", EDITS) == EDITS)
    )
    first = F.col("own_word") < F.col("word")
    pairs = found.select(
        F.least("own_word", "word").alias("a"),
        F.when(first, F.col("own_n")).otherwise(F.col("n")).alias("a_n"),
        F.greatest("own_word", "word").alias("b"),
        F.when(first, F.col("n")).otherwise(F.col("own_n")).alias("b_n"),
    )
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word and root for rows of (word, form), both unique and not null, where forms lead in no circle."""
    step = settle(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = step.join(unbroadcast(further), "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        step = settle(stepped, "spelling-roots")
        ended = step.filter("moved").isEmpty()
        step = step.select("word", "root")
        if ended:
            return step


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for words (word, n) of four or more code points.

    ``words`` is read several times; pass a written table with each word once.
    """
    words = words.select("word", "n")
    pairs = settle(near_pairs(words), "spelling-pairs")
    sides = [
        F.struct(F.col(word).alias("word"), F.col(near).alias("near"), F.col(f"{near}_n").alias("near_n"))
        for word, near in (("a", "b"), ("b", "a"))
    ]
    most = pairs.select(F.explode(F.array(*sides)).alias("own")).select("own.*").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    best_n = -F.col("best.less")
    enough = best_n >= ratio * F.col("n")
    formed = settle(
        words.join(unbroadcast(most), "word", "left").select(
            "word",
            F.when(enough, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(enough, best_n).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(formed.filter("form is not null"))
    return formed.join(unbroadcast(ends), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def document_variants(documents: DataFrame) -> DataFrame:
    """The variants among the words of all documents, some of which are damaged on purpose."""
    words = word_counts(documents, LENGTH, DAMAGED).filter(F.col("n") >= OCCURRENCES)
    return spelling_variants(settle(words, "spelling-words"))
