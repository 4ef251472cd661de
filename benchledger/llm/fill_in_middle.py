"""Fill-in-the-middle: a text is cut at two places between its units and its parts are put in another order.

Units are lines (with their line feed) or code points. Which unit ends where is found eight bytes at a
time: the UTF-8 bytes of an Arrow batch are viewed as 64-bit words, an exact byte-wise comparison by
arithmetic marks the top bit of every byte that ends a unit, ``bitwise_count`` counts the marks of each
word, and running sums over the words tell how many units end before it (rank). The place of the k-th
unit end is found by a binary search in those sums and, inside the word, by one multiplication that gives
the running sums of its eight bytes (select). All texts of a batch are cut together, whatever their lengths.

Only the text goes to Python, and three numbers come back; the parts are put together in column expressions.

What decides a row is the SHA-256 of ``<seed>:<doc_id>``: its first two 32-bit numbers give the places,
the third whether the text is transformed, the fourth in which order. Equal rows get equal results, and so
does a task that is run again.

Null texts are empty, and empty texts stay plain; a null doc_id counts as an empty one. Texts of any
length are cut whole; batches are cut in slices of bounded size. An empty table gives an empty result.
Columns other than doc_id and text are kept as fields of ``others``, so their names clash with none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 7
#: Percentages: of texts that are transformed, and of these, of the ones with the suffix in front.
TRANSFORMED, SUFFIX_FIRST = 100, 50
#: Marks of the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
#: Bytes of text that are cut together.
SLICE_BYTES = 8_000_000

ONES = np.uint64(0x0101010101010101)
TOP = np.uint64(0x8080808080808080)
REST = np.uint64(0x7F7F7F7F7F7F7F7F)
LINE_FEED = np.uint64(0x0A0A0A0A0A0A0A0A)


def marked_bytes(words: np.ndarray, wanted: np.uint64) -> np.ndarray:
    """The top bit of every byte that equals the byte ``wanted`` repeats. No carry leaves a byte."""
    differing = words ^ wanted
    return ~(((differing & REST) + REST) | differing | REST)


def first_bytes(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that begins a code point: all but those of the form 10xxxxxx."""
    return ~(words & ~(words << np.uint64(1))) & TOP


def before_first(starts: np.ndarray) -> np.ndarray:
    """The marks one byte earlier, across words; the last byte of all is marked."""
    following = np.append(starts[1:], TOP) << np.uint64(56)
    return (starts >> np.uint64(8)) | following


class Marked:
    """Rank and select over marked bytes."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """How many of the first ``place`` bytes are marked."""
        word, inside = place >> 3, (place & 7).astype(np.uint64)
        earlier = (np.uint64(1) << (inside * np.uint64(8))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & earlier)

    def select(self, number: np.ndarray) -> np.ndarray:
        """The byte that is marked as number 0, 1, ..."""
        word = np.searchsorted(self.before, number, side="right") - 1
        left = (number - self.before[word]).astype(np.uint64)
        sums = (self.words[word] >> np.uint64(7)) * ONES
        # Byte i of ``sums`` has the marks of bytes 0 to i; the top bit stays where that is ``left`` at most.
        passed = ((left * ONES) | TOP) - sums & TOP
        return word * 8 + np.bitwise_count(passed)


def cut(texts: pa.Array, one: np.ndarray, other: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: its units, and the code points of the prefix and the middle.

    The cuts are after ``one`` and ``other`` modulo (units + 1) units.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(places[-1] - places[0])
    # Whole words, and one more, which ends the last text.
    padded = np.zeros(size // 8 * 8 + 16, np.uint8)
    if size:
        padded[:size] = np.frombuffer(data, np.uint8)[places[0] : places[-1]]
    words = padded.view("<u8")
    start, stop = places[:-1] - places[0], places[1:] - places[0]

    starts = first_bytes(words)
    code_points = Marked(starts)
    ends = Marked(marked_bytes(words, LINE_FEED) if unit == "line" else before_first(starts))
    earlier = ends.rank(start)
    whole = ends.rank(stop) - earlier
    # What follows the last line feed is a line, too.
    units = whole + ((stop > start) & (ends.rank(np.maximum(stop - 1, start)) - earlier == whole))

    def after(number: np.ndarray) -> np.ndarray:
        """The byte after so many units of each text."""
        inside = (number > 0) & (number <= whole)
        place = np.where(number > 0, stop, start)
        place[inside] = ends.select((earlier + number - 1)[inside]) + 1
        return place

    one, other = one % (units + 1), other % (units + 1)
    first, second = after(np.minimum(one, other)), after(np.maximum(one, other))
    prefix = code_points.rank(first) - code_points.rank(start)
    return units, prefix, code_points.rank(second) - code_points.rank(first)


def bounded(texts: pa.Array) -> list[tuple[int, int]]:
    """Ranges of rows of at most SLICE_BYTES of text, or of one row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ranges, start, size = [], 0, 0
    for row, own in enumerate(sizes.tolist()):
        if row > start and size + own > SLICE_BYTES:
            ranges.append((start, row))
            start, size = row, 0
        size += own
    return [*ranges, (start, len(sizes))] if len(sizes) else []


def cuts(text: Column, one: Column, other: Column, unit: str) -> Column:
    """A struct of n, prefix_chars and middle_chars."""

    def found(texts: pa.Array, ones: pa.Array, others: pa.Array) -> pa.Array:
        made = [np.zeros(len(texts), np.int64) for _ in range(3)]
        places = [column.to_numpy(zero_copy_only=False) for column in (ones, others)]
        for start, stop in bounded(texts):
            parts = cut(texts.slice(start, stop - start), places[0][start:stop], places[1][start:stop], unit)
            for column, part in zip(made, parts, strict=True):
                column[start:stop] = part
        return pa.StructArray.from_arrays([pa.array(column) for column in made], ["n", "prefix_chars", "middle_chars"])

    found.__annotations__ = {"texts": pa.Array, "ones": pa.Array, "others": pa.Array, "return": pa.Array}
    return F.arrow_udf(found, "n bigint, prefix_chars bigint, middle_chars bigint")(text, one, other)


def checked_marks(marks: tuple[str, str, str]) -> tuple[str, str, str]:
    """The marks, if none can arise where a part of the text meets a mark."""
    if len(set(marks)) < 3 or any(not mark or mark[0] in other[1:] for mark in marks for other in marks):
        raise ValueError("marks must differ, and no mark may hold the beginning of one further on")
    if any(one != other and other.startswith(one) for one in marks for other in marks):
        raise ValueError("no mark may begin with another")
    return marks


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``output`` of that form was made of."""
    prefix, suffix, middle = checked_marks(marks)

    def between(start: str, end: str) -> Column:
        place = F.locate(start, output) + len(start)
        return F.substr(output, place, F.locate(end, output) - place)

    last = F.substr(output, F.locate(middle, output) + len(middle))
    return (
        F.when(form == "psm", F.concat(between(prefix, suffix), last, between(suffix, middle)))
        .when(form == "spm", F.concat(between(prefix, middle), last, between(suffix, prefix)))
        .otherwise(output)
    )


def fill_in_middle(
    documents: DataFrame,
    unit: str = "line",
    seed: int = SEED,
    transformed: int = TRANSFORMED,
    suffix_first: int = SUFFIX_FIRST,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain), output, others."""
    if unit not in ("line", "code_point"):
        raise ValueError(f"unknown unit {unit!r}")
    prefix, suffix, middle = checked_marks(marks)
    rest = [F.col(f"`{name.replace('`', '``')}`") for name in documents.columns if name.lower() not in ("doc_id", "text")]
    others = [F.struct(*rest).alias("others")] if rest else []
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), digest.alias("digest"), *others)
    number = [F.conv(F.substring("digest", 8 * place + 1, 8), 16, 10).cast("bigint") for place in range(4)]
    plain = (F.col("text") == "") | (number[2] % 100 >= transformed)
    for mark in marks:
        plain = plain | F.contains("text", F.lit(mark))
    form = F.when(plain, "plain").when(number[3] % 100 < suffix_first, "spm").otherwise("psm")
    kept = ["doc_id", "text", *(["others"] if rest else [])]
    rows = rows.select(*kept, form.alias("form"), cuts(F.col("text"), number[0], number[1], unit).alias("cuts"))
    first, second = F.col("cuts.prefix_chars"), F.col("cuts.middle_chars")
    parts = [
        F.substr("text", F.lit(1), first),
        F.substr("text", first + 1, second),
        F.substr("text", first + second + 1),
    ]
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(prefix), parts[0], F.lit(suffix), parts[2], F.lit(middle), parts[1]))
        .when(F.col("form") == "spm", F.concat(F.lit(suffix), parts[2], F.lit(prefix), parts[0], F.lit(middle), parts[1]))
        .otherwise(F.col("text"))
    )
    cut_only = F.col("form") != "plain"
    return rows.select(
        "doc_id",
        F.col("cuts.n").alias("n"),
        "form",
        F.when(cut_only, first).alias("prefix_chars"),
        F.when(cut_only, second).alias("middle_chars"),
        output.alias("output"),
        *kept[2:],
    )


def digests(documents: DataFrame) -> DataFrame:
    """The transformation of every document, its output and what is rebuilt from it as SHA-256."""
    made = fill_in_middle(documents.select("doc_id", "text"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE = """
with units as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') as units,
        sha256('7:' || coalesce(cast(doc_id as varchar), '')) as digest
    from documents
), numbers as (
    select *, len(units) as n, cast('0x' || digest[1:8] as bigint) as h1, cast('0x' || digest[9:16] as bigint) as h2,
        cast('0x' || digest[17:24] as bigint) as h3, cast('0x' || digest[25:32] as bigint) as h4
    from units
), cuts as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 100
            then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form
    from numbers
), parts as (
    select doc_id, text, n, form, coalesce(array_to_string(units[1:a], ''), '') as prefix,
        coalesce(array_to_string(units[a + 1:b], ''), '') as middle, coalesce(array_to_string(units[b + 1:], ''), '') as suffix
    from cuts
)
select doc_id, n, form,
    case when form <> 'plain' then length(prefix) end as prefix_chars,
    case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle else text end) as output_sha256,
    sha256(text) as restored_sha256
from parts
"""
