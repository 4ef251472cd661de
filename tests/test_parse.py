import itertools

import pytest
from pyspark.sql import functions as F

from benchledger.functions import parse
from benchledger.plans import results

GOOD = (
    '{"summary":{"duration":120000000,"requests":3000000,"bytes":400000000,'
    '"errors":{"connect":0,"read":0,"write":0,"status":0,"timeout":0}},'
    '"latency":{"min":90,"mean":1250.5,"max":1.23457e+06,"stdev":300.1,'
    '"percentile":[[1,100],[50,1000],[95,2500],[99,4000]]},'
    '"requests":{"min":1,"mean":2,"max":3,"stdev":1,"percentile":[[50,2]]}}'
)


def changed(old, new):
    assert old in GOOD
    return GOOD.replace(old, new)


CASES = [
    ("no text", None, "no_stdout", "<no wrk stdout for test run>"),
    ("no marker", "abc", "missing_json", parse.MISSING_JSON),
    ("empty text", "", "missing_json", parse.MISSING_JSON),
    ("marker at end", "abcJSON:", "missing_json", parse.MISSING_JSON),
    ("two markers, no text", "abcJSON:JSON:", "missing_json", parse.MISSING_JSON),
    ("marker only", "JSON:", "missing_json", parse.MISSING_JSON),
    ("empty first piece", "aJSON:JSON:" + GOOD, "parse_failed", parse.PARSE_FAILED),
    ("marker at start", "JSON: " + GOOD, "ok", ""),
    ("first of two", "JSON: " + GOOD + " JSON: {}", "ok", ""),
    ("bad first of two", "JSON: {} JSON: " + GOOD, "parse_failed", parse.PARSE_FAILED + " {} "),
    ("text after", "x\nJSON: " + GOOD + "\nbye", "ok", ""),
    ("nan", "JSON: " + changed("1250.5", "nan"), "parse_failed", None),
    ("no status", "JSON: " + changed('"status":0,', ""), "parse_failed", None),
    ("no timeout", "JSON: " + changed(',"timeout":0', ""), "ok", ""),
    ("timeouts only", "JSON: " + changed('"timeout":0', '"timeout":5'), "ok", ""),
    ("no 95", "JSON: " + changed("[95,2500],", ""), "parse_failed", None),
    ("short pair", "JSON: " + changed("[99,4000]", "[99]"), "parse_failed", None),
    ("no request stats", "JSON: " + changed('"stdev":1,', ""), "parse_failed", None),
    (
        "errors",
        "JSON: " + changed('"connect":0', '"connect":1').replace('"status":0', '"status":2'),
        "errors",
        "Connect errors: 1, Status errors: 2",
    ),
    ("zero duration", "JSON: " + changed("120000000", "0"), "no_rate", None),
]


@pytest.fixture(scope="module")
def outcomes(spark):
    rows = [(name, "build", "test", "2020-01-01", text) for name, text, _, _ in CASES]
    schema = "test_run_id string, app_build_id string, test_name string, end_time string, stdout string"
    runs = spark.createDataFrame(rows, schema)
    return {row.test_run_id: row for row in results.run_outcomes(runs).collect()}


@pytest.mark.parametrize("name,_text,outcome,message", CASES, ids=[c[0] for c in CASES])
def test_outcome(outcomes, name, _text, outcome, message):
    assert outcomes[name].outcome == outcome
    if message is not None:
        assert outcomes[name].message.startswith(message)


def test_metrics(outcomes):
    row = outcomes["marker at start"]
    assert (row.requests_per_second, row.latency_mean_ms, row.latency_p95_ms) == (25000.0, 1.2505, 2.5)
    assert outcomes["errors"].requests_per_second is None
    assert outcomes["zero duration"].requests_per_second is None


def test_last_percentile_wins_and_large_max(spark):
    text = "JSON: " + changed("[95,2500]", "[95,20],[95,30]")
    output = parse.parse_output(spark.createDataFrame([(text,)], "stdout string"))
    row = output.select(
        parse.percentile_value(F.col("output")["latency"], 95).alias("p95"),
        F.col("output")["latency"]["max"].alias("largest"),
    ).first()
    assert (row.p95, row.largest) == (30, 1234570.0)


def test_decoding_runs_once(spark):
    runs = spark.createDataFrame([("a", "b", "c", "d", "e")], "test_run_id string, app_build_id string, test_name string, end_time string, stdout string")
    plan = results.run_outcomes(runs).filter("outcome = 'ok'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_display_and_measured_execution(spark):
    row = spark.range(1).select(
        parse.display(F.lit(25000.0), F.lit(1.2505), F.lit(2.5)).alias("text"),
        parse.measured_execution(F.array(F.lit("warm-up"), F.lit("measured"))).alias("last"),
        parse.measured_execution(F.array().cast("array<string>")).alias("none"),
    ).first()
    assert row.text == "Requests/s: 25000.0, Mean latency: 1.2505, Latency 95%: 2.5"
    assert (row.last, row.none) == ("measured", None)


def pieces_of(text):
    """As ``split`` of the marker that leaves out empty pieces at the end."""
    pieces = text.split(parse.MARKER)
    while pieces and not pieces[-1]:
        pieces.pop()
    return pieces[1] if len(pieces) > 1 else None


def test_json_piece_of_all_orders_of_markers(spark):
    texts = ["".join(parts) for count in range(6) for parts in itertools.product(["JSON:", "é{}", "JSON"], repeat=count)]
    rows = spark.createDataFrame([(text,) for text in [*texts, None]], "stdout string")
    found = {row["stdout"]: row["piece"] for row in rows.select("stdout", parse.json_piece(F.col("stdout")).alias("piece")).collect()}
    assert found.pop(None) is None
    assert found == {text: pieces_of(text) for text in texts}


def test_a_piece_is_cut_without_counting_characters():
    # What counts them stands behind the test for an empty piece, and is there once.
    cut = str(parse.json_piece(F.col("stdout")))
    assert cut.count("length(stdout)") == 1
    assert cut.index("split_part") < cut.index("length(stdout)")
