import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from benchledger.llm import personal_data
from tests.llm.conftest import SF

# The plain patterns.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base(text):
    spans = []
    for number, (kind, pattern) in enumerate(PLAIN.items()):
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(part) <= 255 for part in match.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((match.start(), number, match.end(), kind))
    return sorted(spans)


TEXTS = [
    "a@b.com_c@d.org x@y.z.w.q 1.2.3.4.5.6.7.8 4111-1111-1111-1111 +1 (555) 555-1234 256.1.1.1 00.01.001.255",
    "é😀 a@b.c é 4111111111111111 " + "1" * 400 + " +1 " + "2" * 20 + " +12 3456789.",
    "x" * 3000 + "@" + "y" * 3000 + ".com and @x.com a@b a@b. a@-.- ",
    "x@y.com.9999999999999999.1.1.1 +1+12345678901 (+4) +1()()()()2",
    "4111 1111 1111 1111 " * 200,
    "tel: (212) 555-7788 and 12345678901",
]


@pytest.fixture(scope="module")
def rows(spark, odd):
    more = spark.createDataFrame([(100 + n, text) for n, text in enumerate(TEXTS)], "doc_id bigint, text string")
    given = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id") + 1000, "text")
    return odd.select("doc_id", "text").union(more).union(given).cache()


def test_base_spans_equal_the_plain_patterns(rows):
    got = personal_data.personal_data(rows).collect()
    texts = rows.collect()
    assert len(got) == len(texts)
    want = []
    for row in texts:
        spans = base(row.text)
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        counts = tuple(sum(s[3] == kind for s in spans) for kind in PLAIN)
        want.append((str(row.doc_id), *counts, hashlib.sha256(joined.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == sorted(want)
    for row in got:
        if row.doc_id in range(100, 106):
            spans = set(row.spans.split(",")) if row.spans else set()
            assert {f"{kind}:{a}:{b}" for a, _, b, kind in base(TEXTS[row.doc_id - 100])} <= spans


def test_loose_phone_with_a_cue_is_added_and_plain_digits_are_not(rows):
    row = personal_data.personal_data(rows).filter("doc_id = 105").collect()[0]
    assert row.spans == "phone:5:19" and row.n_phone == 0 and row.n_added == 1


def test_redaction_by_hand(spark):
    text = "é a@b.com, 1.2.3.4 x"
    docs = spark.createDataFrame([(1, text, [(2, 0, 9), (4, 2, 7), (11, 1, 18)]), (2, text, [])], f"d int, text string, spans array<{personal_data.SPAN}>")
    got = [row[0] for row in docs.orderBy("d").select(personal_data.redacted(F.col("text"), F.col("spans"))).collect()]
    assert got == ["é [EMAIL], [IP] x", text]


def test_running_ends(spark):
    lengths = list(range(1, 700))
    docs = spark.createDataFrame([(lengths,), ([],)], "l array<int>")
    got = [row[0] for row in docs.select(personal_data.running_ends(F.col("l"))).collect()]
    assert got == [[sum(lengths[: n + 1]) for n in range(len(lengths))], []]


def test_boosting_learns_and_calibrates():
    plain = {name: 0 for name in personal_data.FEATURES}
    counted = []
    for held in (False, True):
        for valid in (0, 1):
            for cue in (0, 1):
                counted.append((plain | {"valid": valid, "cue": cue}, held, 50 * valid, 50 * (1 - valid)))
    model = personal_data.boost(counted)
    assert model.score(plain | {"valid": 1}) >= model.thresholds[0] > model.score(plain)
    assert model.thresholds[1] == float("inf")
    assert personal_data.boost([]).trees == ()


def test_edges(spark, no_rows):
    assert personal_data.personal_data(no_rows).count() == 0
    clash = spark.createDataFrame([(1, "a@b.com", 1, "x")], "doc_id bigint, text string, base int, spans string")
    found = personal_data.find(clash, personal_data.Model((), ())).collect()[0]
    assert [tuple(span) for span in found.spans] == [(0, 0, 7)]


def test_cued_phone_of_any_form_is_added(spark):
    made = ["Tel. 555-123-4567 now", "phone 030 1234 5678 ok", "order 555-123-4567 now", "part 030 1234 5678 ok", "phone 30 12 34", "tel +1 555 123 4567"]
    docs = spark.createDataFrame([(n, made[n % 6]) for n in range(600)], "doc_id bigint, text string")
    found = {row.text: [tuple(s) for s in row.spans] for row in personal_data.find(docs, personal_data.fit(docs)).collect()}
    assert found[made[0]] == [(5, 3, 17)] and found[made[1]] == [(6, 3, 19)]
    assert found[made[2]] == found[made[3]] == found[made[4]] == [] and len(found[made[5]]) == 1


def spans_of(seed, size, length, widest=9):
    chance = random.Random(seed)
    starts = sorted(chance.randrange(length) for _ in range(size))
    return [(a, chance.randrange(4), min(length, a + chance.randint(1, widest))) for a in starts]


SIZES = [(0, 50), (1, 50), (7, 50), (127, 900), (128, 3000), (129, 3000), (700, 9000), (900, 4097)]


def test_span_steps_equal_brute_force(spark):
    made = [(n, spans_of(n, size, length), spans_of(n + 50, size // 3, length)) for n, (size, length) in enumerate(SIZES)]
    made += [(20, spans_of(1, 9, 50), []), (21, [], spans_of(1, 9, 50)), (22, [(0, 0, 5), (5, 1, 9)], [(5, 0, 9), (5, 1, 6)])]
    docs = spark.createDataFrame(made, f"n int, a array<{personal_data.SPAN}>, b array<{personal_data.SPAN}>")
    got = docs.select(
        "n", personal_data.apart_from(F.col("a"), F.col("b")).alias("apart"), personal_data.leftmost(F.col("a")).alias("left")
    )
    by_number = {row.n: row for row in got.collect()}
    for n, a, b in made:
        assert [tuple(s) for s in by_number[n].apart] == [s for s in a if not any(o[0] < s[2] and o[2] > s[0] for o in b)]
        taken = []
        for span in a:
            if not taken or taken[-1][2] <= span[0]:
                taken.append(span)
        assert [tuple(s) for s in by_number[n].left] == taken


def test_redaction_equals_brute_force(spark):
    chance = random.Random(9)
    rows, want = [], []
    for n, (size, length) in enumerate(SIZES):
        text = "".join(chance.choice("ab \n\r\u2028é日😀") for _ in range(length))
        spans = spans_of(n, size, length, widest=5000 if n == 6 else 9)
        rows.append((n, text, spans))
        out, at = "", 0
        for place, (start, kind, end) in enumerate(spans):
            if place == 0 or start >= at:
                out += text[at:start] + f"[{personal_data.KINDS[kind].upper()}]"
            at = max(at, end)
        want.append(out + text[at:])
    docs = spark.createDataFrame(rows, f"n int, text string, spans array<{personal_data.SPAN}>").orderBy("n")
    assert [row[0] for row in docs.select(personal_data.redacted(F.col("text"), F.col("spans"))).collect()] == want


def test_long_text_of_nothing_but_candidates(spark):
    unit = "10.20.30.40 call +1 555 123 4567, tel 555-123-4567 or 300.1.1.1; "
    text = unit * (2_000_000 // len(unit))
    docs = spark.createDataFrame([(n, unit) for n in range(50)], "doc_id bigint, text string")
    model = personal_data.fit(docs)
    long = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    start = time.monotonic()
    found = personal_data.find(long, model).select("spans", personal_data.redacted(F.col("text"), F.col("spans")).alias("out")).collect()[0]
    taken = time.monotonic() - start
    units = len(text) // len(unit)
    one = [(0, 1, 11), (17, 3, 32), (38, 3, 50)]
    assert [tuple(s) for s in found.spans] == [(a + n * len(unit), k, b + n * len(unit)) for n in range(units) for a, k, b in one]
    assert found.out == "[IP] call [PHONE], tel [PHONE] or 300.1.1.1; " * units
    assert taken < 40  # hours, were it the square
    print(f"taken {taken:.1f} s")
