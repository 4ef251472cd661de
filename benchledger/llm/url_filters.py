"""URL rules, indexed by their rarest literal token.

A rule is a regular expression over ``host`` + ``path`` and the tokens that every URL it fits must
contain. Of these the token that the fewest URLs contain becomes the rule's key. Each URL is cut into
tokens once; each token fetches, from a table of buckets that is one constant of the plan, the rules that could
fit, and only those run their expression. Among the rules that fit, the highest (tier, size, name) decides. So a
URL is judged where it lies, without a shuffle, however many pages share it.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased;
the path is what follows up to ``?``, ``#`` or the end. Both are empty for a null URL or one without
``://``; such URLs, and all that no rule fits, get the default verdict. Repeated rows each get the
verdict of their URL; an empty table gives an empty result. Other columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchledger.llm.common import OTHERS, lower_az, put_back, set_apart

#: Rules of one constant; more are looked up in several, one after the other.
RULES_AT_ONCE = 20_000


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    tier: int = 0
    size: int = 0


def place_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and its subdomains where the path starts with ``path``; above all pattern rules."""
    escape = lambda text: re.sub(r"([^A-Za-z0-9/_])", r"\\\1", text)
    # A token at the end of the path may be the start of a longer one.
    whole = re.findall(r"[a-z0-9]+", host) + re.findall(r"[a-z0-9]+(?=[^a-z0-9])", path.lower())
    pattern = rf"^([^/]*\.)?{escape(host)}{escape(path)}"
    return Rule(host + path, verdict, pattern, tuple(whole), tier=1, size=len(host + path))


def word_rule(name: str, words: Sequence[str], verdict: str = "block") -> Rule:
    """Fits hosts in which the words follow each other, divided by ``-`` or ``.`` from each other and the rest."""
    joined = r"[.-]".join(words)
    return Rule(name, verdict, rf"^([^/]*[.-])?{joined}([.:-][^/]*)?(/|$)", tuple(words))


#: Host and path rules, as given.
PLACE_RULES = (
    place_rule("org", "/", "allow"),
    place_rule("example.org", "/es/", "block"),
    place_rule("example.org", "/en/1", "block"),
    place_rule("com", "/fr/", "allow"),
    place_rule("com", "/de/", "block"),
)
#: Kinds of sites that are of no use as text.
WORD_RULES = (
    word_rule("adult", ["adult"]),
    word_rule("ads", ["ads"]),
    word_rule("bets", ["bets"]),
    word_rule("casino", ["casino"]),
    word_rule("pills", ["pills"]),
    word_rule("porn", ["porn"]),
    word_rule("spam", ["spam"]),
    word_rule("cheap-meds", ["cheap", "meds"]),
    word_rule("link-farm", ["link", "farm"]),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = lower_az(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def tokens_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+)"), F.lit(1)))


def index_rules(urls: DataFrame, rules: Sequence[Rule]) -> list[tuple[str, Rule]]:
    """(key token, rule); the empty token for rules without tokens. ``urls`` has the column ``key``."""
    spark = urls.sparkSession
    known = sorted({token for rule in rules for token in rule.tokens})
    if not known:
        return [("", rule) for rule in rules]
    # At most one row for each token of a rule.
    seen = (
        urls.select(F.explode(tokens_of(F.col("key"))).alias("token"))
        .join(F.broadcast(spark.createDataFrame([(token,) for token in known], "token string")), "token", "left_semi")
        .groupBy("token")
        .count()
    )
    count = {row["token"]: row["count"] for row in seen.collect()}
    return [(min(rule.tokens, key=lambda t: (count.get(t, 0), t)) if rule.tokens else "", rule) for rule in rules]


RULE = "struct<token:string,tier:int,size:int,name:string,verdict:string,pattern:string>"


def best_rule(key: Column, tokens: Column, index: Sequence[tuple[str, Rule]]) -> Column:
    """The greatest (tier, size, name, verdict) of the rules that fit, or null."""
    width = 1 << max(1, len(index)).bit_length()
    buckets: list[list[dict]] = [[] for _ in range(width)]
    for token, rule in index:
        one = {"token": token, "tier": rule.tier, "size": rule.size, "name": rule.name, "verdict": rule.verdict, "pattern": rule.pattern}
        buckets[zlib.crc32(token.encode("utf-8")) % width].append(one)
    # A text that the optimiser turns into one constant; thousands of literals would be slow to plan.
    table = F.from_json(F.lit(json.dumps(buckets)), f"array<array<{RULE}>>")

    def fetched(token: Column) -> Column:
        own = F.get(table, (F.crc32(token.cast("binary")) % width).cast("int"))
        return F.filter(own, lambda rule: rule["token"] == token)

    fits = F.filter(F.flatten(F.transform(tokens, fetched)), lambda rule: F.regexp_like(key, rule["pattern"]))
    ranked = F.transform(fits, lambda rule: F.struct(*[rule[name].alias(name) for name in ("tier", "size", "name", "verdict")]))
    return F.array_max(ranked)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """The rows of ``pages`` with host, path, and the name, tier and verdict of the rule that decided.

    Columns of these names (``host``, ``path``, ``rule_name``, ``rule_tier``, ``verdict``), in whatever case, are replaced.
    """
    host, path = host_and_path(F.col(url))
    rows = set_apart(pages, url).withColumns({"_host": host, "_path": path})
    best = F.lit(None).cast("struct<tier:int,size:int,name:string,verdict:string>")
    if rules:
        keys = rows.select(F.concat("_host", "_path").alias("key"))
        index = index_rules(keys, rules)
        rows = rows.withColumn("_key", F.concat("_host", "_path"))
        tokens = tokens_of(F.col("_key"))
        # Rules without a token are tried on every URL.
        tokens = F.array_append(tokens, "") if any(token == "" for token, _ in index) else tokens
        chunks = [index[at : at + RULES_AT_ONCE] for at in range(0, len(index), RULES_AT_ONCE)]
        found = [best_rule(F.col("_key"), F.col("_tokens"), chunk) for chunk in chunks]
        best = F.array_max(F.array(*found))
        rows = rows.withColumn("_tokens", tokens)
    # The generator finds the rule once per row, however many columns read it.
    rows = rows.select(url, OTHERS, "_host", "_path", F.explode(F.array(best)).alias("_best"))
    made = {
        "host": F.col("_host"),
        "path": F.col("_path"),
        "rule_name": F.col("_best.name"),
        "rule_tier": F.col("_best.tier"),
        "verdict": F.coalesce("_best.verdict", F.lit(default)),
    }
    return put_back(rows, pages, [url], made)


def url_verdicts(pages: DataFrame, rules: Sequence[Rule] = PLACE_RULES + WORD_RULES) -> DataFrame:
    """page_id, host, path, rule (of host and path rules), pattern_rule, verdict."""
    judged = judge_urls(pages.select("page_id", "url"), rules)
    name, tier = F.col("rule_name"), F.col("rule_tier")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.when(tier == 1, name).alias("rule"),
        F.when(tier == 0, name).alias("pattern_rule"),
        "verdict",
    )


def _oracle() -> str:
    """DuckDB SQL of :func:`url_verdicts`: every rule on every URL, without the index."""
    hit = [f"WHEN regexp_matches(host || path, '{rule.pattern}') THEN '{rule.name}'" for rule in
           sorted(PLACE_RULES, key=lambda r: (-r.size, r.name))]
    words = [f"WHEN regexp_matches(host || path, '{rule.pattern}') THEN '{rule.name}'" for rule in
             sorted(WORD_RULES, key=lambda r: r.name, reverse=True)]
    blocked = ", ".join(f"'{rule.name}'" for rule in PLACE_RULES if rule.verdict == "block")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), '{upper}', '{lower}') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest
), judged AS (
  SELECT page_id, host, path, CASE {' '.join(hit)} END AS rule, CASE {' '.join(words)} END AS word FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN word END AS pattern_rule,
  CASE WHEN rule IN ({blocked}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN word IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM judged"""


ORACLE = _oracle()
