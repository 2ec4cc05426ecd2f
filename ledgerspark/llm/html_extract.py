"""Main text of web pages by consensus host paths.

1. Each page is read once; its containers are scored by the text of the blocks
   below them (links count against it), and the page votes for the generalised
   tag-class path of its best container (digits in class names become ``#``).
2. Spark counts the votes by host and path (partial sums first, so a host with
   a third of all pages is one row per task before the shuffle) and ranks each
   host's paths.
3. Each page is read again with its host's winning paths: the text comes from
   the containers on the best-ranked path that the page has; a page that has
   none of them falls back to its own best container.

The winners are joined to the pages by host. They are broadcast only when
their written table is counted and small; otherwise the join is a shuffle join
whose hot hosts AQE splits.

Left out wherever they stand: menus, site headers, footers, sidebars, notices,
adverts, forms, scripts, styles, comments of readers (by tag, role, or the
words of class and id). An element that holds an article, a main element or a
first-level heading is never taken for one of these.

Defined results: null or empty html gives an empty text; a null url belongs to
the host ""; broken markup is read to its end; texts are whole; pages that
repeat are extracted each; an empty table gives an empty table.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, table, text_or_empty

#: Paths kept per host, best first (a ranking, not a limit on pages: pages without any of them fall back).
PATHS_PER_HOST = 5
#: The winners are broadcast up to so many hosts.
BROADCAST_HOSTS = 50_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output q "
                   "ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr br".split())
DROP_TAGS = frozenset("script style noscript template iframe noembed noframes svg canvas object embed nav footer aside form "
                      "button select textarea input dialog head title menu audio video map".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                       "toolbar".split())
#: Words in class or id that mark a part of the page as no article text, wherever they stand in a name (main-nav).
DROP_WORDS = frozenset(
    "adv advert adverts advertisement advertising adsense sponsor sponsored sidebar sidenav nav navbar navigation menu menubar "
    "footer masthead topbar breadcrumb breadcrumbs cookie cookies consent gdpr popup modal newsletter subscribe subscription "
    "signup login commentlist disqus respond pagination pager copyright".split())
#: Words that mark it only alone or beside names of places (ad, related-posts), as they stand in other names too (ad-hoc, side-effects).
WEAK_WORDS = frozenset(
    "ad ads promo promotion banner side foot notice notices alert overlay share sharing social related recommended recommendations "
    "comment comments reply replies widget widgets toolbar hidden".split())
PLACE_WORDS = frozenset(
    "a area article articles bar block body bottom box button buttons by card cell col column container content entry form google group "
    "header icon icons id inline "
    "inner item items left link links list main media middle module news outer page panel post posts right row section site slot space "
    "sticky stories story text the top unit user wrap wrapper zone".split())
HEAD_WORDS = frozenset(("header", "head"))
GOOD_WORDS = frozenset("article content entry main post story text body".split())
#: An open element that a start tag of the same group closes.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "body": ("head",)}
#: Where the search for an element to close ends.
SCOPE = frozenset("html body table ul ol dl article section main div td th".split())

#: Elements that can be the container of an article.
CONTAINERS = frozenset("article main section div td body center table dl html".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
                   r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|\Z)", re.S)
ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"']|\Z)""",
                  re.I)
WORDS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")


def marks_aside(names: str) -> bool:
    """Whether a class or id (lower case, names between white space) marks a part that is no article text."""
    for name in names.split():
        words = set(WORDS.findall(name))
        if words & DROP_WORDS or words & WEAK_WORDS and words <= WEAK_WORDS | PLACE_WORDS:
            return True
    return False


class Page:
    """A page as flat lists: elements (tag, parent, dropped, path step) and blocks of text with their element."""

    def __init__(self, source: str):
        self.parent, self.tag, self.step, self.drop, self.good = [-1], [""], [""], [False], [False]
        self.keep, self.inside, self.linked = [False], [False], [False]
        self.blocks: list[tuple[int, str, int]] = []    # element, text, characters in links
        self._read(source)
        self._settle()

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        cls, words, aside, drop = "", set(), False, tag in DROP_TAGS
        if attrs and ("=" in attrs or "hidden" in attrs):
            for name, a, b, c in ATTR.findall(attrs):
                name, value = name.lower(), (a or b or c).lower()
                if name == "class":
                    cls = ".".join(sorted(set(DIGITS.sub("#", value).split())))
                if name in ("class", "id"):
                    words.update(WORDS.findall(value))
                    aside = aside or marks_aside(value)
                elif name == "role":
                    drop |= value in DROP_ROLES
                elif name == "hidden" or name == "aria-hidden" and value == "true" \
                        or name == "style" and re.search(r"display\s*:\s*none", value):
                    drop = True
        inside = self.inside[parent]
        drop |= aside or (not inside and (tag == "header" or not words.isdisjoint(HEAD_WORDS)))
        self.parent.append(parent)
        self.tag.append(tag)
        self.step.append(f"{tag}.{cls}" if cls else tag)
        main = tag == "article" or tag == "main"
        self.inside.append(inside or main)
        self.linked.append(self.linked[parent] or tag == "a")
        self.drop.append(drop and not main and tag not in ("html", "body")
                         or tag == "article" and aside)
        self.good.append(main or not words.isdisjoint(GOOD_WORDS))
        self.keep.append(tag == "main" or tag == "article" and not self.drop[-1] or tag == "h1")
        return len(self.tag) - 1

    def _up(self, node: int) -> Iterator[int]:
        while node > 0:
            yield node
            node = self.parent[node]

    def _read(self, source: str) -> None:
        stack = [0]
        text: list[str] = []
        links, at, size = 0, 0, len(source)

        def flush() -> None:
            nonlocal links
            if text:
                joined = " ".join("".join(text).split())
                if joined:
                    node = stack[-1]
                    while node and self.tag[node] in INLINE:
                        node = self.parent[node]
                    self.blocks.append((node, joined, min(links, len(joined))))
                text.clear()
            links = 0

        def add(raw: str) -> None:
            nonlocal links
            raw = html_lib.unescape(raw) if "&" in raw else raw
            text.append(raw)
            if self.linked[stack[-1]]:
                links += len(raw)

        for m in TOKEN.finditer(source):
            if m.start() < at:
                continue
            if m.start() > at:
                add(source[at:m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                found = next((i for i in range(len(stack) - 1, 0, -1) if self.tag[stack[i]] == tag), 0)
                if tag not in INLINE:
                    flush()
                    if found:
                        del stack[found:]
                elif found and all(self.tag[x] in INLINE for x in stack[found:]):
                    del stack[found:]
                continue
            if tag == "br":
                text.append(" ")
                continue
            if tag not in INLINE:
                flush()
                for i in range(len(stack) - 1, 0, -1):
                    open_tag = self.tag[stack[i]]
                    if open_tag == "p" or open_tag in CLOSES.get(tag, ()):
                        del stack[i:]
                    elif open_tag in SCOPE and open_tag not in CLOSES.get(tag, ()):
                        break
            if tag in VOID:
                continue
            node = self._open(tag, m[3] or "", stack[-1])
            if tag in RAW:
                end = re.compile(rf"</{tag}\s*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else size
                continue
            if not (m[3] or "").endswith("/") or tag not in ("svg", "path"):
                stack.append(node)
        if at < size:
            add(source[at:])
        flush()

    def _settle(self) -> None:
        """An element that holds the article, main or a first heading isn't dropped; what hangs below a dropped one is."""
        for i in range(len(self.tag) - 1, 0, -1):
            if self.keep[i] and self.parent[i] > 0 and not (self.tag[i] == "h1" and self.tag[self.parent[i]] == "header"):
                self.keep[self.parent[i]] = True
        for i in range(1, len(self.tag)):
            self.drop[i] = self.drop[i] and not (self.keep[i] and self.tag[i] not in DROP_TAGS) or self.drop[self.parent[i]]

    def path(self, node: int) -> str:
        steps = [self.step[x] for x in self._up(node) if self.tag[x] not in INLINE]
        return ">".join(reversed(steps))

    def best(self) -> int:
        """The container with the highest score; 0 if the page has no text outside the dropped parts."""
        own: dict[int, float] = {}
        for node, text, links in self.blocks:
            if not self.drop[node]:
                own[node] = own.get(node, 0.0) + max(0, len(text) - 2 * links)
        score: dict[int, float] = {}
        held: dict[int, float] = {}
        for node, worth in own.items():
            share, inner = 1.0, True
            for x in self._up(node):
                tag = self.tag[x]
                if tag in CONTAINERS:
                    score[x] = score.get(x, 0.0) + worth * share * (1.5 if self.good[x] else 1.0)
                    share *= 0.5
                    if inner and (tag == "article" or tag == "main"):
                        held[x], inner = held.get(x, 0.0) + worth, False
        # An article or main element that holds much of the text is the container.
        if held and max(held.values()) >= 0.3 * sum(own.values()):
            return max(held, key=lambda x: (held[x], -x))
        return max(score, key=lambda x: (score[x], -x), default=0)

    def text_under(self, nodes: set[int]) -> str:
        """The blocks below any of the elements, in page order."""
        under = [False] * len(self.tag)
        under[0] = 0 in nodes
        for i in range(1, len(under)):
            under[i] = i in nodes or under[self.parent[i]]
        return "\n\n".join(t for node, t, _ in self.blocks if under[node] and not self.drop[node])

    def on_path(self, path: str) -> set[int]:
        last = path.rpartition(">")[2]
        return {i for i in range(1, len(self.tag)) if self.step[i] == last and not self.drop[i] and self.path(i) == path}


def _vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths = [], []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(source)
            node = page.best()
            if node:
                hosts.append(host)
                paths.append(page.path(node))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string())], ["host", "path"])


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, paths = [], []
        for source, winners in zip(batch.column("_html").to_pylist(), batch.column("_winners").to_pylist()):
            page = Page(source)
            nodes, path = set(), None
            for path in winners or ():
                nodes = page.on_path(path)
                if nodes and page.text_under(nodes):
                    break
            else:
                node = page.best()
                nodes, path = {node}, page.path(node)
            texts.append(page.text_under(nodes))
            paths.append(path)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string()), pa.array(paths, pa.string())],
            ["_id", "_url", "_text", "_path"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_votes(rows: DataFrame) -> DataFrame:
    """(host, path, votes) from rows of ``_host`` and ``_html``."""
    votes = rows.select("_host", "_html").mapInArrow(_vote, "host string, path string")
    return votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"))


def winning_paths(votes: DataFrame, k: int = PATHS_PER_HOST) -> DataFrame:
    """Per host its paths with most votes, best first (ties by path)."""
    ranked = F.transform(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path"))), 1, k),
                         lambda x: x["path"])
    return votes.groupBy("host").agg(ranked.alias("_winners"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page the id, url, text, its number of code points and the path that it came from."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "html")
    url = text_or_empty(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"),
                        host_of(url).alias("_host"), text_or_empty(F.col(html_col)).alias("_html"))
    winners = scratch.keep(winning_paths(host_votes(rows)), "winners")
    if winners.count() <= BROADCAST_HOSTS:
        winners = F.broadcast(winners)
    joined = rows.join(winners, F.col("_host") == F.col("host"), "left")
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = joined.select("_id", "_url", "_html", "_winners").mapInArrow(
        _extract, f"_id {kind['_id']}, _url {kind['_url']}, _text string, _path string")
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), F.col("_text").alias("text"),
                      F.length("_text").cast("long").alias("n_chars"), F.col("_path").alias("path"))


def op2_html_extract(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages"))


QUERIES = {"op2_html_extract": op2_html_extract}
ORACLE: dict[str, str] = {}
