import html
import re
import time
from collections import defaultdict

import pytest

from benchledger.llm import html_extraction as extraction
from tests.llm.conftest import SF

NONE = frozenset()
CASES = {
    "": "",
    "just text & more": "just text & more",
    "<p>a<p>b</p>c": "a\nb\nc",
    "<div>a <b>b</b>\n c&nbsp;&eacute;&#233;</div><div>d</div>": "a b c éé\nd",
    "<body><nav>menu</nav><header>site</header><article><header><h1>T</h1></header><p>x</p>"
    "<section class='comments'><p>c</p></section></article><aside>s</aside><footer>f</footer></body>": "T\nx",
    "<script>var a='</p>';</script><style>p{}</style><p>x</p><noscript>n</noscript><!-- <p>c</p> -->": "x",
    "<p>x</p><script>never closed <p>y</p>": "x",
    "<p>x</p><!-- never closed <p>y</p>": "x",
    "<ul><li>a<li>b<ul><li>c</ul></ul>": "a\nb\nc",
    "<table><tr><td>a<td>b<tr><td>c</table>": "a\nb\nc",
    "a < b <3 x": "a < b <3 x",
    "<p title=\"a>b\" class='ad'>x</p><p title='>'>y</p>": "y",
    "<form><p>f</p></form><div class='cookie-notice'>n</div><div role='navigation'>m</div><p>t</p>": "t",
    "<div class='with sidebar'><main><p>x</p></main></div>": "x",
    "<article class='comment'>c</article><p>x</p>": "x",
    "x</b></p></div>y": "x y",
    "a<br>b": "a b",
    '<article><p>x</p><p class="share-price">5 euro</p></article>': "x\n5 euro",
    '<article><p>x</p><div class="ad-hoc"><p>keep me</p></div></article>': "x\nkeep me",
    '<div class="ad-hoc"><p>keep me</p></div><div class="ad-box">buy</div>': "keep me",
    "<p>a</p><!--><p>b</p><!---><p>c</p><!-- x --!><p>d</p>": "a\nb\nc\nd",
    "<p>a</p><object data=x><p>b</p>": "a\nb",
    "<p>a</p><object data=x><p>b</p></object><svg><text>s</text></svg><select><option>o</select><svg/>c": "a\nc",
    "<p>a</p><noscript><p>b</p>": "a\nb",
    "<p>a</p><template><p>b</p>": "a\nb",
    "<p>a <b c='>d": "a d",
    "<p>a</p><img alt='x > y'><p>b</p><img alt=\"it's\"><p>c</p>": "a\nb\nc",
    "<p>a</p><p title='open>b</p><p>c</p>": "a\nb\nc",
    "<title>a</title><textarea><p>x</p></textarea>b<form>c</form>": "b",
    "a <b": "a <b",
    "a <b <!-- c": "a <b",
}


@pytest.mark.parametrize("page", CASES)
def test_cases(page):
    assert extraction.main_text(page, NONE) == CASES[page]


def test_deep_and_long_pages():
    assert extraction.main_text("<div>" * 20_000 + "x" + "</div>" * 20_000, NONE) == "x"
    assert extraction.main_text("<p>" + "word " * 200_000, NONE) == ("word " * 200_000).strip()


@pytest.mark.parametrize("end", ["", ">", '">', "'>", "-->", "</script>", "</p>"])
@pytest.mark.parametrize(
    "piece",
    ["<a", "<a ", '<a href="x ', "<a href='x> ", "<!", "<!-- ", "</", "</b", "<b c=\"'>", '<a ">', "<a \"'", "<p><b>", "<script", "<td><table>", "<li><ul>",
     "<svg>", "<object>", "< ", "<a class=", "&", "<script></script ", "<!-- --><p>", "x</div>", "<p class='a"],
)
def test_damaged_pages_take_time_in_proportion(piece, end):
    page = piece * (1_000_000 // len(piece)) + end
    start = time.process_time()
    extraction.main_text(page, NONE)
    took = time.process_time() - start
    assert took < 3


def page(n, extra=""):
    return f"<div><span>Follow us</span> <span>now</span></div><div><p>own {n}</p>{extra}</div><p>recurring words</p>"


@pytest.mark.parametrize("broadcast", [extraction.BROADCAST_SUBTREES, 0])
def test_recurring_subtrees_of_a_host_are_deleted(spark, monkeypatch, broadcast):
    monkeypatch.setattr(extraction, "BROADCAST_SUBTREES", broadcast)
    rows = [(n, f"http://a.org/{n}", page(n)) for n in range(6)]
    rows += [(10 + n, f"http://b{n}.org/", page(n)) for n in range(6)]
    rows += [(20, None, None), (21, "http://a.org/x", ""), (22, "http://a.org/0", page(0)), (None, "http://c.org", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {row.page_id: row for row in extraction.main_texts(pages).collect()}
    assert len(got) == len(rows) and got[20].text == got[21].text == "" and got[22].text == got[0].text == "own 0"
    assert all(got[n].text == f"own {n}" and got[10 + n].text == f"Follow us now\nown {n}\nrecurring words" for n in range(6))
    assert all(row.n_chars == len(row.text) for row in got.values())


def test_recurring_paragraphs_of_articles_stay(spark):
    made = "<article><h1>{0}</h1><p>the same</p><p>own words {0}</p><div><a>share this</a></div></article><footer>f</footer>"
    pages = spark.createDataFrame([(n, f"http://a.org/{n}", made.format(n)) for n in range(8)], "page_id bigint, url string, html string")
    assert {row.text for row in extraction.main_texts(pages).collect()} == {f"{n}\nthe same\nown words {n}" for n in range(8)}


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {row.page_id: row.text for row in extraction.main_texts(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", part)).split()) for part in re.split(r"</?p>|</?h1>|<br>", article)]
        assert got[row.page_id] == "\n".join(part for part in blocks if part)


def texts(spark, made, hosts="http://a.org/{}"):
    rows = [(n, hosts.format(n), text) for n, text in enumerate(made)]
    return [r.text for r in extraction.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).orderBy("page_id").collect()]


@pytest.mark.parametrize("outer", ["article", "div"])
def test_recurring_parts_of_the_main_text_stay(spark, outer):
    """Inline elements, rows and copies of a page are no template, whatever marks the main text."""
    row = "<tr><td><div>yes</div><td>10 m<sup>2</sup></tr>"
    own = "<{0}><p>words of page {1} by <cite>Ann</cite>, <time>1999</time></p><table>{2}<tr><td>{1}</td></table><ol><li>same</li><li>{1}</li></ol></{0}>"
    made = [own.format(outer, f"number {n}", row) for n in range(8)]
    assert texts(spark, made) == [
        f"words of page number {n} by Ann, 1999\nyes\n10 m2\nnumber {n}\nsame\nnumber {n}" for n in range(8)
    ]
    # One page under eight addresses, with other menus.
    copy = "<nav>menu {0}</nav><{1}><p>the one article</p><ul><li>a</li></ul><div>its end</div></{1}><div>by us</div>"
    assert {text.split("\nby us")[0] for text in texts(spark, [copy.format(n, outer) for n in range(8)])} == {"the one article\na\nits end"}


def test_templates_stand_on_their_path_and_leave_most_of_the_text(spark):
    ends = "<div><b>Call us</b></div>"
    made = [f"<div><p>own words of page {n}, rather many of them</p></div>{ends}" for n in range(8)]
    made += [f"<section><p>page {n} quotes</p>{ends}<p>more words</p></section>" for n in range(8, 10)]
    got = texts(spark, made)
    assert got[0] == "own words of page 0, rather many of them" and got[8] == "page 8 quotes\nCall us\nmore words"
    most = "<div><p>a long passage that all of them have</p><p>and its end</p></div><p>note {0}</p>"
    assert texts(spark, [most.format(n) for n in range(8)]) == [f"a long passage that all of them have\nand its end\nnote {n}" for n in range(8)]
    teased = "<article><p>join us</p></article><article><h1>{0}</h1><p>this is the page of number {0}</p></article>"
    assert texts(spark, [teased.format(n) for n in range(8)]) == [f"{n}\nthis is the page of number {n}" for n in range(8)]


def templates_by_hand(pages):
    """The templates of each host, counted in one go."""
    beside = defaultdict(set)
    for _, url, page in pages:
        host = re.sub(r"[/?#].*", "", url.split("://", 1)[1], flags=re.S).lower() if url and "://" in url else ""
        root = extraction.parse(page or "")
        beside[host, None].add(root.body >> 1)
        for node in extraction.subtrees(root):
            rest = root.body if node.key % 2 else (root.body - node.body) % 2**64
            beside[host, node.key].add(rest >> 1)
    made = {}
    for (host, key), bodies in beside.items():
        total = len(beside[host, None])
        enough, keys = made.setdefault(host, [total >= extraction.ENOUGH_PAGES, set()])
        least = extraction.LEAST_SLOTS if key and key % 2 else max(extraction.LEAST_PAGES, extraction.SHARE * total)
        if key is not None and len(bodies) >= least:
            keys.add(key)
    return {host: found for host, found in made.items() if found[0] or found[1]}


def test_templates_of_the_given_pages(spark):
    """Counted by hand over the whole table, and what they change."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [tuple(row) for row in pages.select("page_id", "url", "html").collect()]
    # Twenty times as many pages of the hosts, so that hosts have enough.
    hosts = [re.sub(r"://[^/]*", f"://host{n % 9}.org", url) for n, (_, url, _) in enumerate(rows)]
    rows = [(n, host, page) for n, (host, (_, _, page)) in enumerate(zip(hosts, rows, strict=True))]
    rows += [(1000, "http://few.org/", rows[0][2]), (1001, None, rows[1][2]), (1002, "http://host1.org/", None)]
    made = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    want = templates_by_hand(rows)
    got = {row.host: [row.enough, set(row.subtrees)] for row in extraction.template_subtrees(made).collect()}
    assert got == want and sum(found[0] for found in want.values()) == 9
    texts = {row.page_id: row.text for row in extraction.main_texts(made).collect()}
    changed = 0
    for page_id, url, page in rows:
        enough, template = want.get(re.sub(r".*://([^/]*).*", r"\1", url or ""), [False, set()])
        assert texts[page_id] == extraction.main_text(page or "", frozenset(template), enough)
        changed += texts[page_id] != extraction.main_text(page or "", NONE, enough)
    assert changed == len(rows) - 3
    # They leave the article and nothing else.
    for page_id, _, page in rows[:-3]:
        assert texts[page_id] == extraction.main_text(re.search(r"<article>.*</article>", page, re.S).group(0), NONE)


def test_only_recurrence_decides_on_large_hosts(spark):
    made = "<nav><ul><li>menu {0}</li></ul></nav><div class='ad'>buy {0}</div><div><p>words of page {0}</p></div><footer>{0}</footer>"
    rows = [made.format(n) for n in range(30)]
    rows[7] = rows[7].replace("<div><p>", "<aside>a remark</aside><div class='share'>once</div><div><p>")
    got = texts(spark, rows)
    assert got[3] == "words of page 3" and got[7] == "a remark\nonce\nwords of page 7"


def test_no_pages(spark):
    assert extraction.main_texts(spark.createDataFrame([], "page_id bigint, url string, html string, host int")).count() == 0
