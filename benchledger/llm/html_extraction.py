"""Main text of web pages by removal of site templates.

Subtrees are hashed and Spark counts, per host, beside how many different bodies each stands, where a body is
the page's text without the subtree and without furniture, so copies of a page count once. Two kinds count:

- a block subtree by tag, class and id, texts, the hashes of the children, and the path of tags from the body.
  Inline elements, list items, rows and cells, and what is inside them or in a paragraph or heading, are
  never template. It recurs beside at least ``SHARE`` of the host's bodies and ``LEAST_PAGES`` of them.
- a slot: an element that looks like furniture (a menu, header, footer, sidebar, advert, notice or comments,
  by its tag or a whole name in class, id or role), by its tag, names and path alone, as its words change from
  page to page. It recurs beside ``LEAST_SLOTS`` bodies.

What recurs is deleted where it stands on that path. On a host of ``ENOUGH_PAGES`` different bodies nothing else
decides: neither the look of an element nor an article's tag. On a host of fewer, elements that look like furniture go as
well, and if the page marks its articles, those that are not template are read, and nothing else. In an article, or
else in the innermost element with half of the page's text, paragraphs and headings stay although they recur;
what holds half of the text stays on any page. Forms, scripts, styles and the head go on any host.

Text is cut into blocks at block elements; character references are decoded, white space in a block
becomes one space, and blocks are joined by one line feed. Null and empty pages have empty text, text
without any markup is one block, and unclosed elements end where HTML ends them; an object, drawing or the like
that is never closed keeps its content. A tag that never ends is text. Parsing takes time in proportion to the
page, however damaged that is. Pages without a host are counted together as those of the empty host. Repeated rows
are extracted alike. Columns other than page_id, url and html, whatever their names, are left out.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchledger.llm.common import texts_of
from benchledger.llm.url_filters import host_and_path
from benchledger.session import settle

LEAST_PAGES = 4
SHARE = 0.01
LEAST_SLOTS = 2
#: Different bodies of a host from which on only recurrence decides.
ENOUGH_PAGES = 12
#: A host's pages are joined with its templates in so many parts.
SALTS = 16
#: Up to so many subtrees (8 bytes each) all templates go to every task; beyond it pages meet them in a shuffle.
BROADCAST_SUBTREES = 1_000_000
#: Entries that a task gathers before it passes them on.
COUNTED = 200_000

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe script style textarea title xmp".split())
#: Elements that go with their content if they are closed, and those that go on any page.
SKIPPED = frozenset("math noembed noframes noscript object select svg template".split())
DROPPED = frozenset("button form head".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
ENDED_BY_NEXT = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"),
}
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt b i em strong span a code figcaption".split())
ROWS = frozenset("li dt dd tr td th thead tbody tfoot caption figcaption legend summary".split())
#: Elements that may be template, and those in which nothing is.
TEMPLATE = BLOCK - ROWS - frozenset("html body hr".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 pre".split())
WHOLE = ROWS | PARAGRAPHS
HOLDERS = BLOCK - PARAGRAPHS
FURNITURE = frozenset("aside dialog footer menu nav search".split())
#: Names in class, id or role that mark furniture, also together and with the words of ``NEUTRAL``.
MARKS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies copyright footer gdpr "
    "header login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup "
    "promo recommended related share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
COMMENTS = frozenset("comment comments disqus replies respond".split())
NEUTRAL = frozenset(
    "area bar block bottom box button buttons container content elements fixed global group inner item items left links list "
    "local main message new page primary right secondary section site slot sticky top unit wrap wrapper".split()
)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+)>")
TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
QUOTE_OR_END = re.compile(r"[>\"']")
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD = re.compile(r"[a-z0-9]+")
ENDS = {name: re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE) for name in RAW}


LOW_64 = (1 << 64) - 1
STEP = 0x9E3779B97F4A7C15


@lru_cache(maxsize=10_000)
def marked(names: str, marks: frozenset[str]) -> bool:
    """Whether one of the names is made of marks, and of neutral words beside them."""
    for name in names.split():
        words = set(WORD.findall(name))
        if words & marks and words <= marks | NEUTRAL:
            return True
    return False


@lru_cache(maxsize=10_000)
def number_of(tag: str) -> int:
    return xxhash.xxh64_intdigest(tag.encode("utf-8", "surrogatepass"))


class Node:
    """``body`` and ``prose`` are without furniture: the sum of the hashes of the texts, and their length outside links."""

    __slots__ = ("tag", "names", "children", "hash", "size", "main", "body", "prose", "key", "ended")

    def __init__(self, tag: str, names: str):
        self.tag, self.names = tag, names
        self.children: list[Node | str] = []
        self.hash = self.size = self.body = self.prose = self.key = 0
        self.main = tag in ("article", "main")
        self.ended = False  # by its own end tag

    def close(self) -> None:
        """Hash, length of text, whether an article is inside, and what is beside furniture."""
        parts = [self.tag, self.names]
        for child in self.children:
            if isinstance(child, str):
                parts.append(child)
                self.size += len(child)
                self.prose += len(child)
                if text := child.strip():
                    self.body += xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
            else:
                if dropped(child):
                    child.size = 0
                parts.append(f"<{child.hash:x}>")
                self.size += child.size
                self.main |= child.main and child.size > 0
                if child.size and not furniture(child, True):
                    self.body += child.body
                    self.prose += child.prose
        self.body &= LOW_64
        if self.tag == "a":
            self.prose = 0
        self.hash = xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) >> 1


def parse(page: str) -> Node:
    """The page's tree; every node is closed."""
    root = Node("#page", "")
    stack, open_, at = [root], Counter(), 0

    def end(place: int) -> None:
        while len(stack) > place:
            node = stack.pop()
            open_[node.tag] -= 1
            node.close()

    def ended_before(tag: str) -> None:
        if tag in BLOCK and open_["p"]:
            for place in range(len(stack) - 1, 0, -1):
                if stack[place].tag == "p":
                    end(place)
                    break
                if stack[place].tag in BLOCK:
                    break
        siblings = ENDED_BY_NEXT.get(tag)
        if siblings and any(open_[name] for name in siblings):
            for place in range(len(stack) - 1, 0, -1):
                if stack[place].tag in siblings:
                    end(place)
                    if tag not in ("tr", "tbody"):
                        break
                elif stack[place].tag in ("ul", "ol", "dl", "table", "select", "menu"):
                    break

    def write(text: str) -> None:
        if "&" in text:
            text = entities.unescape(text)
        if text:
            stack[-1].children.append(text)

    last_end = page.rfind(">")
    no_end: set[int] = set()  # quotes from which on no tag ends
    while True:
        place = page.find("<", at)
        if place < 0 or place > last_end:
            # No tag ends any more; only a comment may still begin.
            place = page.find("<!--", at)
            write(page[at:] if place < 0 else page[at:place])
            break
        if page.startswith("<!--", place):
            write(page[at:place])
            at = comment_end(page, place)
            if at < 0:
                break
            continue
        if page[place + 1 : place + 2] in ("!", "?"):
            write(page[at:place])
            at = page.find(">", place) + 1
            continue
        found = TAG.match(page, place)
        if found:
            closing, tag, described, stop = found[1], found[2], found[3], found.end()
        elif found := TAG_NAME.match(page, place):
            stop = tag_end(page, found.end(), no_end)
            closing, tag, described = found[1], found[2], page[found.end() : stop - 1]
        else:
            write(page[at : place + 1])
            at = place + 1
            continue
        write(page[at:place])
        at = stop
        tag = tag.lower()
        if closing:
            if open_[tag]:
                place = next(p for p in range(len(stack) - 1, 0, -1) if stack[p].tag == tag)
                stack[place].ended = True
                end(place)
            elif tag in ("p", "br"):
                stack[-1].children.append(" ")
            continue
        ended_before(tag)
        if tag in VOID:
            node = Node(tag, "")
            node.close()
            stack[-1].children.append(node)
            continue
        if tag in RAW:
            if described.endswith("/"):
                continue
            ending = ENDS[tag].search(page, at) if at <= last_end else None
            if ending is None:
                break
            at = ending.end()
            continue
        names = " ".join((a or b or c).lower() for _, a, b, c in NAMED.findall(described)) if "=" in described else ""
        node = Node(tag, names)
        node.ended = tag in SKIPPED and described.endswith("/")
        stack[-1].children.append(node)
        if not node.ended:
            stack.append(node)
            open_[tag] += 1
    end(0)
    return root


def comment_end(page: str, place: int) -> int:
    """Where the comment that begins there has ended, or -1. ``<!-->`` and ``<!--->`` are whole comments."""
    for short in ("<!-->", "<!--->"):
        if page.startswith(short, place):
            return place + len(short)
    end = page.find("-->", place + 4)
    other = page.find("--!>", place + 4, end if end >= 0 else len(page))
    return other + 4 if other >= 0 else end + 3 if end >= 0 else -1


def tag_end(page: str, at: int, no_end: set[int]) -> int:
    """Where a tag has ended whose name ends at ``at``: behind the next ``>`` outside quotes, or if a quote is never closed,
    behind the next one. There is a ``>`` further on.

    ``no_end`` holds the quotes that led nowhere, so that no part of the page is tried twice in vain.
    """
    passed, place = [], at
    while True:
        found = QUOTE_OR_END.search(page, place)
        if found and found[0] == ">":
            return found.end()
        if found is None or found.start() in no_end:
            break
        passed.append(found.start())
        closing = page.find(found[0], found.end())
        if closing < 0:
            break
        place = closing + 1
    no_end.update(passed)
    return page.find(">", at) + 1


def dropped(node: Node) -> bool:
    """Whether the element goes with its content on any page."""
    return node.tag in DROPPED or (node.tag in SKIPPED and node.ended)


def subtrees(root: Node) -> Iterator[Node]:
    """The elements with text that may be template; each gets its key, of the hash and the path from the body.

    Keys of slots are odd, those of subtrees even. Nothing inside a slot is looked at.
    """
    left = [(root, 0, False)]
    while left:
        node, path, in_main = left.pop()
        for child in node.children:
            if isinstance(child, str) or not child.size or dropped(child):
                continue
            own = path
            if child.tag not in ("html", "body"):
                own = (path * STEP + number_of(child.tag)) & LOW_64
            if furniture(child, in_main):
                own = (own * STEP + number_of(child.names)) & LOW_64
                child.key = (own >> 1) | 1
                yield child
                continue
            if child.tag in TEMPLATE:
                child.key = ((child.hash * STEP + own) & LOW_64) >> 1 & ~1
                yield child
            if child.tag not in WHOLE:
                left.append((child, own, in_main or child.tag in ("article", "main")))


def furniture(node: Node, in_main: bool) -> bool:
    """Whether the element looks like furniture. In the main text only blocks do, and no header."""
    if node.tag in ("html", "body", "#page"):
        return False
    if node.tag in FURNITURE or (node.tag == "header" and not in_main and not node.main):
        return True
    if not node.names or (in_main and node.tag not in HOLDERS):
        return False
    return marked(node.names, COMMENTS) or (not node.main and marked(node.names, MARKS))


def deleted(node: Node, root: Node, template: frozenset[int], in_main: bool) -> bool:
    """Whether the element is template and neither holds half of the text nor, in the main text, is prose."""
    if node.key not in template or (in_main and (node.tag in PROSE or 2 * node.size >= root.size)):
        return False
    return not node.prose or 2 * node.prose < root.prose


def articles(root: Node, template: frozenset[int]) -> list[Node]:
    """The outermost articles that are neither furniture nor template, else the outermost main elements."""
    for tag in ("article", "main"):
        found, left = [], [root]
        while left:
            node = left.pop()
            if node.tag == tag and node.size:
                if not deleted(node, root, template, False):
                    found.append(node)
                continue
            left.extend(c for c in reversed(node.children) if not isinstance(c, str) and c.main and not furniture(c, False))
        if found:
            return found
    return []


def holder(root: Node) -> Node | None:
    """The innermost element with half of the page's text, if it is not the body."""
    node = root
    while True:
        inner = (c for c in node.children if not isinstance(c, str) and c.tag in HOLDERS and c.prose)
        found = next((c for c in inner if 2 * c.prose >= root.prose and not furniture(c, False)), None)
        if found is None:
            return None if node.tag in ("html", "body", "#page") else node
        node = found


def blocks(root: Node, template: frozenset[int], is_article: bool, looks: bool = True) -> list[str]:
    """The text blocks of what is not deleted; ``looks`` says that furniture goes although it does not recur."""
    made: list[str] = []
    line: list[str] = []
    main = holder(root) if template and not is_article else None
    in_main = is_article

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            made.append(text)

    # After the children None ends a block and False the main text.
    left: list[Node | str | bool | None] = [root]
    while left:
        node = left.pop()
        if node is None:
            flush()
            continue
        if node is False:
            in_main = is_article
            continue
        if isinstance(node, str):
            line.append(node)
            continue
        if node is not root:
            like = furniture(node, in_main)
            if dropped(node) or (like and (looks or node.key in template)) or (not like and deleted(node, root, template, in_main)):
                line.append(" ")
                continue
        if not in_main and (node is main or node.tag in ("article", "main")):
            in_main = True
            left.append(False)
        if node.tag in BLOCK:
            flush()
            left.append(None)
            left.extend(reversed(node.children))
        elif node.tag in VOID:
            line.append(" " if node.tag in ("br", "img", "wbr", "input", "embed") else "")
        else:
            left.extend(reversed(node.children))
    flush()
    return made


def main_text(page: str, template: frozenset[int], enough: bool = False) -> str:
    """``enough``: the host has so many pages that only recurrence decides."""
    root = parse(page)
    for _ in subtrees(root):  # for the keys
        pass
    if enough and (made := blocks(root, template, False, looks=False)):
        return "\n".join(made)
    made = []
    for article in articles(root, template):
        made += blocks(article, template, True)
    if not made:
        made = blocks(root, template, False) or blocks(root, frozenset(), False)
    return "\n".join(made)


def template_subtrees(pages: DataFrame, least_pages: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """host, enough, subtrees (keys) of every host that has either.

    A host has at most (elements of a page) / ``share`` subtrees, and slots as its pages have places for them.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts, keys, bodies = [], [], []

        def out() -> pa.RecordBatch:
            columns = [pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(bodies, pa.int64())]
            for values in (hosts, keys, bodies):
                values.clear()
            return pa.record_batch(columns, names=["host", "subtree", "body"])

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), texts_of(batch, "html"), strict=True):
                root = parse(page)
                # Number -1 counts the bodies of the host.
                rests = {(-1, root.body >> 1)}
                for node in subtrees(root):
                    # Furniture is no part of the body.
                    own = 0 if node.key & 1 else node.body
                    rests.add((node.key, ((root.body - own) & LOW_64) >> 1))
                hosts += [host] * len(rests)
                keys += [key for key, _ in rests]
                bodies += [body for _, body in rests]
                if len(hosts) > COUNTED:
                    yield out()
        yield out()

    host, _ = host_and_path(F.col("url"))
    is_slot = F.col("subtree").bitwiseAND(F.lit(1)) == 1
    counts = (
        pages.select(host.alias("host"), "html")
        .mapInArrow(counted, "host string, subtree bigint, body bigint")
        .dropDuplicates(["host", "subtree", "body"])
        .groupBy("host", "subtree")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= F.when(is_slot, F.lit(LEAST_SLOTS)).otherwise(F.lit(least_pages)))
    )
    # From the second grouping on there are few rows: a host has at most 1 / share subtrees per element.
    counts = settle(counts, "page-subtrees")
    totals = counts.filter(F.col("subtree") == -1).select("host", F.col("n").alias("pages"))
    found = counts.filter(F.col("subtree") != -1).join(totals, "host").filter(is_slot | (F.col("n") >= share * F.col("pages")))
    lists = found.groupBy("host").agg(F.sort_array(F.collect_list("subtree")).alias("subtrees"))
    return (
        totals.join(lists, "host", "left")
        .select("host", (F.col("pages") >= ENOUGH_PAGES).alias("enough"), F.coalesce("subtrees", F.array().cast("array<bigint>")).alias("subtrees"))
        .filter("enough or size(subtrees) > 0")
    )


def extract(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    host, _ = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("bigint"), "url", "html").withColumn("host", host)
    size = templates.agg(F.coalesce(F.sum(F.size("subtrees")), F.lit(0))).first()[0]
    if size <= BROADCAST_SUBTREES:
        rows = rows.join(F.broadcast(templates), "host", "left")
    else:
        # A host may have a third of all pages, so its pages go to several tasks.
        salt = F.pmod(F.xxhash64(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), F.lit(SALTS)).cast("int")
        salted = templates.withColumn("salt", F.explode(F.array(*[F.lit(number) for number in range(SALTS)])))
        rows = rows.withColumn("salt", salt).join(salted.hint("merge"), ["host", "salt"], "left")
    rows = rows.select("page_id", "url", "html", "subtrees", F.coalesce("enough", F.lit(False)).alias("enough"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = zip(batch.column("subtrees").to_pylist(), batch.column("enough").to_pylist(), strict=True)
            texts = [
                main_text(page, frozenset(found or ()), enough)
                for page, (found, enough) in zip(texts_of(batch, "html"), hosts, strict=True)
            ]
            yield pa.record_batch(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(extracted, "page_id bigint, url string, text string, n_chars bigint")


def main_texts(pages: DataFrame) -> DataFrame:
    """Find the templates of all hosts and extract every page."""
    templates = settle(template_subtrees(pages), "page-templates")
    return extract(pages, templates)
