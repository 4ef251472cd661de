import re

import pytest

from benchledger.llm import url_filters
from benchledger.llm.url_filters import Rule, place_rule, word_rule
from tests.compare import difference, oracle_connection

URLS = [
    "https://a.example.org/es/1", "http://example.org/en/1", "https://x.org/en/12", "http://org/", "http://org", "https://ORG/x?y",
    "ftp://b.example.com/fr/", "b.example.com/fr/", None, "", "://", "https://notorg/", "http://m.x.com/FR/", "http://x.com/de/5#f",
    "https://www.casino-win.example.com/a", "https://casinos.example.com/", "http://cheap-pills.com:80/de", "http://ads-track.org/de/",
    "http://spam.net?x=/fr/", "http://example.org/en/1", "http://example.org/en/1",
]


def by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


PLACES = {("org", "/"): "allow", ("example.org", "/es/"): "block", ("example.org", "/en/1"): "block", ("com", "/fr/"): "allow", ("com", "/de/"): "block"}


def test_host_and_path_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string")
    got = {row.page_id: row for row in url_filters.url_verdicts(pages).collect()}
    assert len(got) == len(URLS)
    for number, url in enumerate(URLS):
        host, path = by_hand(url)
        fits = [h + p for h, p in PLACES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits, key=len, default=None)
        assert (got[number].host, got[number].path, got[number].rule) == (host, path, rule), url
        if rule:
            assert got[number].verdict == next(v for (h, p), v in PLACES.items() if h + p == rule)
        else:
            assert got[number].verdict == ("block" if got[number].pattern_rule else "allow")
    assert got[14].pattern_rule == "casino" and got[15].pattern_rule is None and got[16].pattern_rule == "pills"


@pytest.mark.parametrize("at_once", [url_filters.RULES_AT_ONCE, 1])
def test_index_finds_what_all_rules_find(spark, monkeypatch, at_once):
    """Rules with rare, common and no tokens, against running every expression on every URL."""
    monkeypatch.setattr(url_filters, "RULES_AT_ONCE", at_once)
    rules = [
        place_rule("example.org", "/en/", "block"), place_rule("org", "", "allow"),
        Rule("digits", "block", r"/[0-9]{3}$", (), size=1), Rule("en", "block", r"/en/", ("en",), size=2),
    ]
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {row.page_id: (row.rule_name, row.verdict) for row in url_filters.judge_urls(pages, rules).collect()}
    for row in pages.collect():
        key = "".join(by_hand(row.url))
        fits = [rule for rule in rules if re.search(rule.pattern, key)]
        best = max(fits, key=lambda r: (r.tier, r.size, r.name), default=None)
        assert got[row.page_id] == ((best.name, best.verdict) if best else (None, "allow"))


def test_many_rules_on_a_url_that_many_pages_share(spark):
    rules = [word_rule(f"r{n}", [f"word{n}"]) for n in range(3_000)]
    urls = ["http://a.word77.org/x"] * 500 + [None] * 500 + ["http://word2999.org/", "http://other.org/word5"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    judged = url_filters.judge_urls(pages, rules)
    got = {}
    for row in judged.collect():
        got.setdefault((row.rule_name, row.verdict), []).append(row.page_id)
    assert {k: len(v) for k, v in got.items()} == {("r77", "block"): 500, (None, "allow"): 501, ("r2999", "block"): 1}
    assert "Exchange" not in judged._jdf.queryExecution().executedPlan().toString()


def test_key_is_the_rarest_token(spark):
    urls = spark.createDataFrame([("a.b/c",), ("a.b/d",), ("a.x/d",)], "key string")
    index = url_filters.index_rules(urls, [Rule("1", "block", "x", ("a", "b", "c")), Rule("2", "block", "x", ("a", "zz")), Rule("3", "block", "x", ())])
    assert [token for token, _ in index] == ["c", "zz", ""]


def test_edges(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string, host string, verdict int")
    assert url_filters.url_verdicts(empty).count() == 0
    one = spark.createDataFrame([(1, "http://x.org/", "h", 5), (None, "http://x.org/", None, None)], empty.schema)
    assert [row.verdict for row in url_filters.judge_urls(one, []).collect()] == ["allow", "allow"]
    assert sorted(row.host for row in url_filters.judge_urls(one, url_filters.PLACE_RULES).collect()) == ["x.org", "x.org"]


def test_oracle(spark):
    from benchledger.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.01"
    rows, problem = difference(QUERIES["op8_url_filters"](spark, sf), oracle_connection(sf), ORACLE["op8_url_filters"])
    assert problem is None and rows == 250
