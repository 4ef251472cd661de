"""Personal data by candidates, boosted trees and calibrated thresholds, in column expressions only.

Generators propose spans, freely and overlapping. The strict generators (e-mail, IP address, payment
card, phone number; one pattern each, leftmost and not overlapping) give the base spans: those that
pass their check. The loose generators propose written-out e-mail addresses, phone numbers without
``+``, cards and addresses with other dividers. Every candidate is described by a few small numbers on
its format and context (``FEATURES``), so all candidates of a corpus fall into at most ``CELLS``
different descriptions.

Spark counts the candidates by description and weak label: a strict candidate is good if it passes
its check; a loose one is good if a word before it says what it is and its form is valid, or for a phone
number its count of digits; otherwise it is bad if its form is not valid, and has no label if it is. Gradient boosting fits trees to these counts,
and each kind's threshold is the lowest score from which the labels of held-out documents are at least
``PRECISION`` good. Loose candidates that reach it and overlap no other span are added; base spans
always stay.

Offsets are code points, end exclusive. Null and empty texts have no spans. Without candidates to learn
from nothing is added. Work in a text follows its length and n log n of its spans. Repeated rows are judged alike; other columns, whatever their names, are left as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchledger.llm.common import OTHERS, put_back, remainder, set_apart
from benchledger.llm.quality_rules import let

# Fixed values, in the order that decides between spans of one start.
KINDS = ("email", "ip", "card", "phone")
# The look-behinds and possessive loops find the same matches as the plain patterns, in linear time.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\[at\]|\(at\))\x20?"
    r"[A-Za-z0-9-]{1,63}+(?:\x20?(?:\[dot\]|\(dot\)|\.)\x20?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:\x20?(?:\[\.\]|\(\.\)|\.)\x20?[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}+(?:[./_\x20-]{1,2}+[0-9]{4}+){2,3}+(?![0-9])",
    "phone": r"(?<![0-9+])(?:00|\()?+[0-9]{2,4}+(?:[)./\x20-]{1,2}+[0-9]{2,4}+){2,4}+(?![0-9])",
}
#: Texts without a match have no candidate of the kind.
NEEDS = {
    ("email", True): "@",
    ("email", False): r"(?:\[at\]|\(at\))",
    ("ip", True): r"[0-9]\.[0-9]",
    ("ip", False): r"[0-9]",
    ("card", True): r"[0-9]",
    ("card", False): r"[0-9]",
    ("phone", True): r"\+[0-9]",
    ("phone", False): r"[0-9]",
}
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|adress|address|correo|courriel)",
    "ip": r"(?i)\b(?:ip|host|server|addr|node|gateway)",
    "card": r"(?i)\b(?:card|visa|master|amex|credit|karte|carte|tarjeta|pay)",
    "phone": r"(?i)\b(?:tel|phone|call|fax|mobile|cell|telefon|whatsapp|sms)",
}
CONTEXT = 32
#: Features of a candidate and the number of values that each can take.
FEATURES = {
    "kind": 4, "loose": 2, "digits": 8, "valid": 2, "dividers": 3, "joined_before": 2, "joined_after": 2,
    "cue": 2, "opened": 2, "uniform": 2,
}
#: Values of the feature for 9 to 15 digits.
PHONE_DIGITS = (2, 3, 4)
#: Bound on what the driver gets: descriptions, times label and held-out.
CELLS = math.prod(FEATURES.values()) * 6
ROUNDS, RATE, DEPTH = 40, 0.3, 3
PRECISION = 0.99
#: Values stepped over with one copied array.
BLOCK = 128
#: Code points of a piece of a text that is rebuilt.
PIECE = 4096


def scanned(values: Column, start: Column, step: Callable[[Column, Column], Column], of: str) -> Column:
    """``start`` stepped over the values: an array of the state (of type ``of``) after each.

    Blocks keep the number of copied elements small.
    """
    none = F.array().cast(f"array<{of}>")

    def block(state: Column, number: Column) -> Column:
        def add(made: Column, value: Column) -> Column:
            return F.array_append(made, step(F.coalesce(F.try_element_at(made, F.lit(-1)), state["last"]), value))

        def closed(made: Column) -> Column:
            return F.struct(F.element_at(made, -1).alias("last"), F.array_append(state["done"], made).alias("done"))

        return F.aggregate(F.slice(values, number * BLOCK + 1, F.lit(BLOCK)), none, add, closed)

    first = F.struct(start.cast(of).alias("last"), F.array().cast(f"array<array<{of}>>").alias("done"))
    numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
    return F.when(F.size(values) == 0, none).otherwise(F.aggregate(numbers, first, block, lambda state: F.flatten(state["done"])))


def running_ends(lengths: Column) -> Column:
    """Sums of the first 1, 2, ... lengths."""
    return let(lengths, lambda own: scanned(own, F.lit(0), lambda end, length: end + length, "int"))


def count_below(ordered: Column, limit: Column) -> Column:
    """How many of the ascending numbers are below ``limit``, by halving."""

    def halve(state: Column, _: Column) -> Column:
        middle = F.shiftright(state["low"] + state["high"], 1)
        below = F.get(ordered, middle) < limit
        open_ = state["low"] < state["high"]
        return F.struct(
            F.when(open_ & below, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(open_ & ~below, middle).otherwise(state["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(0), F.floor(F.log2(F.size(ordered) + 1)).cast("int"))
    whole = F.struct(F.lit(0).alias("low"), F.size(ordered).alias("high"))
    return F.aggregate(steps, whole, halve, lambda state: state["low"])


def matches_of(text: Column, pattern: str) -> Column:
    """start, end, match, the last characters before it and the next one, for every match."""

    def pairs(found: Column, gaps: Column) -> Column:
        lengths = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda match, gap: F.length(gap) + F.length(match))

        def described(ends: Column) -> Column:
            def one(match: Column, at: Column) -> Column:
                end = F.get(ends, at)
                gap = F.get(gaps, at)
                return F.struct(
                    (end - F.length(match)).alias("start"),
                    end.alias("end"),
                    match.alias("match"),
                    F.right(gap, F.lit(CONTEXT)).alias("before"),
                    F.left(F.get(gaps, at + 1), F.lit(1)).alias("after"),
                )

            return F.transform(found, one)

        return let(running_ends(lengths), described)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda own: let(F.split(text, pattern, -1), lambda gaps: pairs(own, gaps)))


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    size = F.length(digits)

    def add(total: Column, at: Column) -> Column:
        digit = F.substring(digits, size - at + 1, F.lit(1)).try_cast("int")
        twice = F.when(at % 2 == 0, digit * 2).otherwise(digit)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def passes(kind: str, match: Column, loose: bool) -> Column:
    """The check of a kind; of a loose match, whether its form is valid."""
    digits = only_digits(match)
    if kind == "email":
        return match.rlike(r"(?:\.|dot[\])]\x20?)[A-Za-z]{2,}$") if loose else F.lit(True)
    if kind == "ip":
        parts = F.filter(F.split(match, r"[^0-9]+"), lambda part: part != "")

        def small(part: Column) -> Column:
            number = F.regexp_replace(part, "^0+", "")
            return (F.length(number) <= 3) & (F.coalesce(number.try_cast("int"), F.lit(0)) <= 255)

        return F.forall(parts, small)
    if kind == "card":
        return F.length(digits).between(12, 19) & let(digits, luhn)
    form = match.rlike(r"[()]|^00") if loose else F.lit(True)
    return F.length(digits).between(9, 15) & form


def candidates_of(text: Column, kind: str, loose: bool) -> Column:
    """The candidates of one generator, with their features."""
    matches = matches_of(text, (LOOSE if loose else STRICT)[kind])

    def described(found: Column) -> Column:
        match = found["match"]
        digits = only_digits(match)
        size = F.length(digits)
        dividers = F.array_distinct(F.regexp_extract_all(match, F.lit("[^A-Za-z0-9]"), F.lit(0)))
        flag = lambda test: F.coalesce(test, F.lit(False)).cast("int")
        bin_ = F.lit(7)
        for number, most in reversed(list(enumerate((6, 8, 11, 12, 15, 16, 19)))):
            bin_ = F.when(size <= most, number).otherwise(bin_)
        return F.struct(
            found["start"].alias("start"),
            found["end"].alias("end"),
            F.lit(KINDS.index(kind)).alias("kind"),
            F.lit(int(loose)).alias("loose"),
            bin_.alias("digits"),
            flag(passes(kind, match, loose)).alias("valid"),
            F.least(F.size(dividers), F.lit(2)).alias("dividers"),
            flag(found["before"].rlike(r"[A-Za-z0-9]$")).alias("joined_before"),
            flag(found["after"].rlike(r"^[A-Za-z0-9]")).alias("joined_after"),
            flag(found["before"].rlike(CUES[kind])).alias("cue"),
            flag(match.rlike(r"^[+(]")).alias("opened"),
            flag(digits.rlike(r"^([0-9])\1*$")).alias("uniform"),
        )

    fields = ["start", "end", *FEATURES]
    empty = F.array().cast("array<struct<" + ",".join(f"{name}:int" for name in fields) + ">>")
    found = F.transform(F.filter(matches, lambda m: m["match"] != ""), described)
    return F.when(text.rlike(NEEDS[kind, not loose]), found).otherwise(empty)


def apart_from(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others, in n log n."""

    def among(own: Column) -> Column:
        starts = F.transform(own, lambda o: o["start"])
        # The greatest end among the first others tells whether any of them reaches over a place.
        reach = scanned(own, F.lit(0), lambda end, o: F.greatest(end, o["end"]), "int")

        def free(known: Column) -> Column:
            def alone(span: Column) -> Column:
                before = count_below(known["starts"], span["end"])
                return F.coalesce(F.get(known["reach"], before - 1), F.lit(0)) <= span["start"]

            return F.filter(spans, alone)

        return let(F.struct(starts.alias("starts"), reach.alias("reach")), free)

    placed = F.array_sort(F.transform(others, lambda o: F.struct(o["start"].alias("start"), o["end"].alias("end"))))
    return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(let(placed, among))


def all_candidates(text: Column) -> Column:
    """Every candidate; loose ones that overlap a base span are left out."""
    strict = F.concat(*[candidates_of(text, kind, False) for kind in KINDS])
    loose = F.concat(*[candidates_of(text, kind, True) for kind in KINDS])

    def with_loose(own: Column) -> Column:
        # Most texts have no loose candidate at all.
        return F.concat(own, let(loose, lambda new: apart_from(new, F.filter(own, lambda s: s["valid"] == 1))))

    return let(strict, with_loose)


@dataclass(frozen=True)
class Node:
    """A leaf's value in millionths, so that sums are exact everywhere, or a test ``feature <= limit``."""

    value: int = 0
    feature: str = ""
    limit: int = 0
    low: Node | None = None
    high: Node | None = None

    def of(self, row: dict[str, int]) -> int:
        if not self.feature:
            return self.value
        return (self.low if row[self.feature] <= self.limit else self.high).of(row)

    def column(self, field: Callable[[str], Column]) -> Column:
        if not self.feature:
            return F.lit(self.value)
        return F.when(field(self.feature) <= self.limit, self.low.column(field)).otherwise(self.high.column(field))


@dataclass(frozen=True)
class Model:
    trees: tuple[Node, ...]
    thresholds: tuple[float, ...]

    def score(self, row: dict[str, int]) -> int:
        return sum(tree.of(row) for tree in self.trees)

    def accepts(self, candidate: Column) -> Column:
        """Whether a candidate's score reaches the threshold of its kind."""
        if not self.trees:
            return F.lit(False)
        score = F.lit(0)
        for tree in self.trees:
            score = score + tree.column(lambda name: candidate[name])
        limit = F.lit(math.inf)
        for kind, threshold in enumerate(self.thresholds):
            limit = F.when(candidate["kind"] == kind, threshold).otherwise(limit)
        return score >= limit


def grow(cells: list[tuple[dict[str, int], float, float]], depth: int) -> Node:
    """A tree for cells of (description, sum of gradients, sum of curvatures)."""
    gradient, curvature = sum(c[1] for c in cells), sum(c[2] for c in cells)
    gain = lambda g, h: g * g / (h + 1.0)
    best = (1e-6, "", 0)
    if depth:
        for feature, values in FEATURES.items():
            sums = [[0.0, 0.0] for _ in range(values)]
            for row, g, h in cells:
                sums[row[feature]][0] += g
                sums[row[feature]][1] += h
            low_g = low_h = 0.0
            for limit in range(values - 1):
                low_g, low_h = low_g + sums[limit][0], low_h + sums[limit][1]
                better = gain(low_g, low_h) + gain(gradient - low_g, curvature - low_h) - gain(gradient, curvature)
                if better > best[0]:
                    best = (better, feature, limit)
    _, feature, limit = best
    if not feature:
        return Node(value=round(1e6 * RATE * gradient / (curvature + 1.0)))
    low = [c for c in cells if c[0][feature] <= limit]
    high = [c for c in cells if c[0][feature] > limit]
    return Node(feature=feature, limit=limit, low=grow(low, depth - 1), high=grow(high, depth - 1))


def boost(counted: list[tuple[dict[str, int], bool, int, int]]) -> Model:
    """``counted``: (description, held out, good, bad) of the labelled candidates."""
    learn = [(row, good, bad) for row, held, good, bad in counted if not held]
    if not learn:
        return Model((), ())
    trees: list[Node] = []
    scores = [0] * len(learn)
    for _ in range(ROUNDS):
        cells = []
        for (row, good, bad), score in zip(learn, scores, strict=True):
            chance = 1 / (1 + math.exp(-score / 1e6))
            cells.append((row, good - (good + bad) * chance, (good + bad) * chance * (1 - chance)))
        trees.append(tree := grow(cells, DEPTH))
        scores = [score + tree.of(row) for score, (row, _, _) in zip(scores, learn, strict=True)]
    model = Model(tuple(trees), ())
    thresholds = []
    for kind in range(len(KINDS)):
        held = sorted(
            ((model.score(row), good, bad) for row, out, good, bad in counted if out and row["kind"] == kind),
            key=lambda cell: -cell[0],
        )
        threshold, good_so_far, all_so_far = math.inf, 0, 0
        for place, (score, good, bad) in enumerate(held):
            good_so_far, all_so_far = good_so_far + good, all_so_far + good + bad
            last = place + 1 == len(held) or held[place + 1][0] < score
            if last and score > 0 and good_so_far >= PRECISION * all_so_far:
                threshold = score
        thresholds.append(threshold)
    return Model(tuple(trees), tuple(thresholds))


def fit(documents: DataFrame) -> Model:
    """Counts all candidates of all documents by description and boosts on the counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    one = F.col("one")
    phone = (one["kind"] == KINDS.index("phone")) & one["digits"].isin(*PHONE_DIGITS)
    label = (
        F.when(one["loose"] == 0, one["valid"])
        .when(((one["valid"] == 1) | phone) & (one["cue"] == 1), 1)
        .when(one["valid"] == 0, 0)
    )
    rows = (
        documents.select((remainder(F.col("doc_id"), 5) == 0).alias("held"), F.explode(all_candidates(text)).alias("one"))
        .select("held", label.alias("label"), *[one[name].alias(name) for name in FEATURES])
        .filter(F.col("label").isNotNull())
        .groupBy("held", *FEATURES)
        .agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
        .orderBy("held", *FEATURES)
    )
    counted = rows.collect()  # at most CELLS rows
    return boost([({name: row[name] for name in FEATURES}, row["held"], row["good"], row["bad"]) for row in counted])


SPAN = "struct<start:int,kind:int,end:int>"


def leftmost(spans: Column) -> Column:
    """Of spans by start, each that begins where the last one taken has ended."""
    ends = scanned(spans, F.lit(0), lambda end, s: F.when(s["start"] >= end, s["end"]).otherwise(end), "int")
    return let(ends, lambda own: F.filter(spans, lambda s, at: F.coalesce(F.get(own, at - 1), F.lit(0)) <= s["start"]))


def find(documents: DataFrame, model: Model) -> DataFrame:
    """The rows with ``base`` and ``spans`` (base and added): arrays of (start, kind, end), in order.

    Columns of these names, in whatever case, are replaced; the others stay, whatever their names.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def span(candidate: Column) -> Column:
        return F.struct(*[candidate[name].alias(name) for name in ("start", "kind", "end")])

    def selected(own: Column) -> Column:
        base = F.array_sort(F.transform(F.filter(own, lambda c: (c["loose"] == 0) & (c["valid"] == 1)), span))
        added = F.array_sort(F.transform(F.filter(own, lambda c: (c["loose"] == 1) & model.accepts(c)), span))

        new = let(added, leftmost)
        return let(base, lambda b: F.struct(b.alias("base"), F.array_sort(F.concat(b, new)).alias("spans")))

    found = F.explode(F.array(let(all_candidates(text), selected))).alias("_found")
    rows = set_apart(documents, "text").select("text", OTHERS, found)
    return put_back(rows, documents, ["text"], {name: F.col("_found")[name] for name in ("base", "spans")})


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def merged(spans: Column) -> Column:
    """Spans by start, of which those that overlap are one with the first's kind."""

    def union(last: Column, one: Column) -> Column:
        longer = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], one["end"]).alias("end"))
        return F.when(one["start"] < last["end"], longer).otherwise(one)

    def last_of_each(states: Column) -> Column:
        return F.filter(states, lambda s, at: F.coalesce(F.get(states, at + 1)["start"] != s["start"], F.lit(True)))

    first = F.struct(*[F.lit(0).alias(name) for name in ("start", "kind", "end")])
    return let(scanned(spans, first, union, SPAN), last_of_each)


def between(pieces: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end`` out of its pieces of ``PIECE`` code points each."""

    def part(number: Column) -> Column:
        low = F.greatest(start - number * PIECE, F.lit(0))
        return F.substring(F.get(pieces, number), low + 1, F.least(end - number * PIECE, F.lit(PIECE)) - low)

    numbers = F.sequence(F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int"))
    return F.when(end > start, F.array_join(F.transform(numbers, part), "")).otherwise("")


def redacted(text: Column, spans: Column) -> Column:
    """The text with ``[KIND]`` for every span; of overlapping spans, for all together, the first's kind."""
    labels = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])

    def rebuilt(known: Column) -> Column:
        apart, pieces = known["apart"], known["pieces"]

        def replaced(one: Column, at: Column) -> Column:
            before = F.coalesce(F.get(apart, at - 1)["end"], F.lit(0))
            return F.concat(between(pieces, before, one["start"]), F.get(labels, one["kind"]))

        rest = between(pieces, F.element_at(apart, -1)["end"], F.length(text))
        return F.concat(F.array_join(F.transform(apart, replaced), ""), rest)

    # A text's own places are counted from its start each time; those of a short piece soon are found.
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    known = F.struct(merged(spans).alias("apart"), pieces.alias("pieces"))
    return F.when(F.size(spans) > 0, let(known, rebuilt)).otherwise(text)


def personal_data(documents: DataFrame) -> DataFrame:
    """Per document: base spans by kind, the digest of the base spans, all spans, number of added ones."""
    documents = documents.select(F.col("doc_id").cast("bigint"), "text")
    found = find(documents, fit(documents))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        F.size(F.filter(kinds, F.lit(number).__eq__)).cast("bigint").alias(f"n_{kind}")
        for number, kind in enumerate(KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"),
    )
