"""Main text of web pages by wrapper inference: one union-free regular expression for the pages of a host.

A page is read as nested token streams, one for each element. Streams of the same host are aligned token by token:
what both have stays, what only one has becomes optional, neighbours with the same label become one repeated group
whose own streams are aligned in turn, and text becomes a slot. The expression that comes out is the host's wrapper.
Its slots are judged once, by where they stand in it; then each page's text is read through these judgements.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import once, ship, stage

TEXT = "#"
DEEPEST = 100
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
#: block elements that hold text but say nothing about its place in the page
PLAIN = frozenset("html p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption hr address center".split())
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset("article articlebody post postbody entry story main maincontent content".split())
NO_CONTENT_TAGS = frozenset("head title nav footer aside form button select option textarea input noscript template iframe object svg math canvas audio video dialog menu map".split())
#: words in class, id and role that name what is not the article
NO_CONTENT_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar topbar pager pagination toc skip masthead footer foot copyright legal disclaimer contentinfo"
    " sidebar sidebars aside rail widget widgets complementary related recommended more"
    " notice notices cookie cookies consent gdpr alert alerts banner popup modal overlay toast warning"
    " ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promoted promotion"
    " comment comments commentlist discussion disqus reply replies respond responses"
    " share sharing social newsletter subscribe subscription signup login search searchbox form".split()
)
HEADER_WORDS = frozenset(("header", "head", "pageheader", "siteheader"))
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_KEEPS_IN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S | re.I,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

Pattern = list  # [label, how often ("1", "?", "+", "*"), streams inside]


def label(tag: str, attributes: str) -> str:
    """An element's tag with the words of its class, id and role, numbers left out."""
    if "=" not in attributes:
        return tag
    words = {w.lower() for m in _NAMES.finditer(attributes) for w in _WORD.findall(m[2] or m[3] or m[4] or "")}
    return ".".join([tag, *sorted(words)])


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, attributes or text): `open`, `close` and `text`; comments, scripts and styles are left out."""
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", "", page[at : m.start()]
        at = m.end()
        name = m[3] or m[6]
        if name:
            yield "close" if (m[2] or m[5]) else "open", name.lower(), m[4] or m[7] or ""
    if at < len(page):
        yield "text", "", page[at:]


class Reader:
    """Walk a page's tokens with the implied ends that HTML has; gives the stream tree and the text blocks."""

    def __init__(self, page: str, tree: bool):
        self.stack: list[tuple[str, str]] = []  # tag, label
        self.paths: list[tuple[str, ...]] = [()]
        self.root: Pattern = ["", "1", []]
        self.open: list[Pattern] = [self.root]
        self.parts: dict[tuple[str, ...], list[str]] = {}
        self.blocks: list[tuple[tuple[str, ...], str]] = []
        self.tree = tree
        for kind, name, rest in tokens(page):
            if kind == "text":
                self._text(rest)
            elif kind == "open":
                self._open(name, rest)
            else:
                self._close(name)
        self._flush()
        while self.stack:
            self._pop()

    def _text(self, raw: str) -> None:
        if not self.tree:
            self.parts.setdefault(self.paths[-1], []).append(entities.unescape(raw) if "&" in raw else raw)
        elif raw.strip():
            stream = self.open[-1][2]
            if not stream or stream[-1][0] != TEXT:
                stream.append([TEXT, "1", []])

    def _flush(self) -> None:
        for path, parts in self.parts.items():
            if text := " ".join("".join(parts).split()):
                self.blocks.append((path, text))
        self.parts = {}

    def _pop(self) -> None:
        tag, _ = self.stack.pop()
        self.paths.pop()
        if tag not in INLINE:
            self._flush()
        if self.tree and len(self.stack) >= DEEPEST:
            self.open.pop()
        elif self.tree:
            self.open[-1][2] = fold(self.open[-1][2])
            self.open.pop()

    def _pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self._pop()

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            if not self.tree:
                self.parts.setdefault(self.paths[-1], []).append(" ")
            return
        if tag not in INLINE:
            self._flush()
            self._end_before(tag)
        if tag in VOID:
            return
        name = label(tag, attributes)
        self.stack.append((tag, name))
        shown = tag not in INLINE and tag not in PLAIN or "." in name and not NO_CONTENT_WORDS.isdisjoint(name.split(".")[1:])
        self.paths.append((*self.paths[-1], name) if shown else self.paths[-1])
        if len(self.stack) > DEEPEST:  # what is nested deeper counts as text of this depth
            self.paths[-1] = self.paths[-2]
        if self.tree and len(self.stack) > DEEPEST:
            self.open.append(self.open[-1])
        elif self.tree:
            node = [name, "1", []]
            self.open[-1][2].append(node)
            self.open.append(node)

    def _end_before(self, tag: str) -> None:
        """A block ends an open paragraph; an item ends the item before it."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == "p":
                self._pop_to(i)
                break
            if self.stack[i][0] not in INLINE:
                break
        ends, keeps = _CLOSED_BY.get(tag, ()), _KEEPS_IN.get(tag, ())
        if ends:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in ends and not (tag == "td" and self.stack[i][0] == "tr"):
                    self._pop_to(i)
                    break
                if self.stack[i][0] in keeps:
                    break

    def _close(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                return self._pop_to(i)
            if tag in INLINE and self.stack[i][0] not in INLINE:
                return None  # an inline end does not reach out of its block
        return None


def _often(a: str, b: str) -> str:
    """How often, for two that are aligned with each other."""
    many, may = "+" in a + b or "*" in a + b, "?" in a + b or "*" in a + b
    return "*" if many and may else "+" if many else "?" if may else "1"


def fold(stream: list[Pattern]) -> list[Pattern]:
    """Neighbours with one label become a repeated group; their inner streams are aligned."""
    out: list[Pattern] = []
    for node in stream:
        if out and out[-1][0] == node[0]:
            many = "+" if out[-1][1] in "1+" or node[1] in "1+" else "*"
            out[-1] = [node[0], "1" if node[0] == TEXT and many == "+" else many, align(out[-1][2], node[2])]
        else:
            out.append(node)
    return out


def align(a: list[Pattern], b: list[Pattern]) -> list[Pattern]:
    """One stream that matches both: the longest common order of labels stays, everything else becomes optional."""
    if a == b:
        return a
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out: list[Pattern] = []
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0]:
            out.append([a[i][0], _often(a[i][1], b[j][1]), align(a[i][2], b[j][2])])
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append([a[i][0], _often(a[i][1], "?"), a[i][2]])
            i += 1
        else:
            out.append([b[j][0], _often(b[j][1], "?"), b[j][2]])
            j += 1
    return fold(out)


def page_pattern(page: str) -> list[Pattern]:
    return fold(Reader(page, tree=True).root[2])


def as_expression(stream: list[Pattern]) -> str:
    """The wrapper as a regular expression over tags, for people."""
    show = {"1": "", "?": "?", "+": "+", "*": "*"}
    return " ".join(TEXT if n[0] == TEXT and n[1] == "1" else (f"({TEXT}){show[n[1]]}" if n[0] == TEXT else f"(<{n[0]}> {as_expression(n[2])} </{n[0].split('.')[0]}>){show[n[1]]}") for n in stream)


def _is_main(name: str) -> bool:
    tag, *words = name.split(".")
    return tag in MAIN_TAGS or not MAIN_WORDS.isdisjoint(words)


def _has_main(node: Pattern) -> bool:
    return any((n[0].split(".")[0] in MAIN_TAGS and NO_CONTENT_WORDS.isdisjoint(n[0].split(".")[1:])) or _has_main(n) for n in node[2])


def judge(wrapper: list[Pattern]) -> dict[tuple[str, ...], int]:
    """For each place of the wrapper's text slots: 2 in the article, 1 neither in it nor ruled out, 0 ruled out.

    An element is ruled out by its tag or by a word in its class, id or role, unless it holds the article itself.
    """
    places: dict[tuple[str, ...], int] = {}

    def walk(stream: list[Pattern], path: tuple[str, ...], worth: int) -> None:
        for node in stream:
            name = node[0]
            if name == TEXT:
                places[path] = max(places.get(path, 0), worth)
                continue
            tag, *words = name.split(".")
            out = tag in NO_CONTENT_TAGS or not NO_CONTENT_WORDS.isdisjoint(words)
            out |= worth < 2 and (tag == "header" or not HEADER_WORDS.isdisjoint(words))
            out &= tag not in ("html", "body") and not (worth < 2 and _has_main(node))
            shown = tag not in INLINE and tag not in PLAIN or not NO_CONTENT_WORDS.isdisjoint(words)
            below = 0 if out or not worth else 2 if worth == 2 or (_is_main(name) and (tag in MAIN_TAGS or not _has_main(node))) else 1
            walk(node[2], (*path, name) if shown else path, below)

    walk(wrapper, (), 1)
    return places


def main_text(page: str, places: dict[tuple[str, ...], int]) -> str:
    """The blocks of the article; of all that is not ruled out, if the page has no article."""
    blocks = Reader(page, tree=False).blocks
    missing = [p for p, _ in blocks if p not in places]
    if missing:
        places = judge(page_pattern(page)) | places
    worth = [places.get(p, 0) for p, _ in blocks]
    least = 2 if 2 in worth else 1
    return "\n".join(t for (_, t), w in zip(blocks, worth, strict=True) if w >= least)


def host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


_HOSTS_AT_ONCE, _SEEN_AT_ONCE = 2000, 20_000


def _merged(pairs: Iterable[tuple[str, str]]) -> dict[str, list[Pattern]]:
    found: dict[str, list[Pattern]] = {}
    for name, pattern in pairs:
        new = json.loads(pattern)
        found[name] = align(found[name], new) if name in found else new
    return found


def infer(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON): one wrapper for each host, from all its pages.

    Every task aligns the pages it reads, host by host, and hands on what it has; per host at most a few expressions
    from each task then meet. So a host with most of the pages costs no more there than any other.
    """
    ship(__name__)

    def local(frames):
        found: dict[str, list[Pattern]] = {}
        seen: set[tuple[str, str]] = set()
        for frame in frames:
            for name, page in zip(frame["host"], frame["html"], strict=True):
                pattern = page_pattern(page or "")
                mark = (name, json.dumps(pattern))
                if mark in seen:
                    continue
                if len(seen) >= _SEEN_AT_ONCE:
                    seen.clear()
                seen.add(mark)
                found[name] = align(found[name], pattern) if name in found else pattern
                if len(found) >= _HOSTS_AT_ONCE:
                    yield pd.DataFrame({"host": list(found), "wrapper": [json.dumps(p) for p in found.values()]})
                    found.clear()
                    seen.clear()
        yield pd.DataFrame({"host": list(found), "wrapper": [json.dumps(p) for p in found.values()]}, dtype=object)

    def together(group: pd.DataFrame) -> pd.DataFrame:
        merged = _merged(zip(group["host"], group["wrapper"], strict=True))
        return pd.DataFrame({"host": list(merged), "wrapper": [json.dumps(p) for p in merged.values()]})

    partly = pages.select(host(F.col("url")).alias("host"), "html").mapInPandas(local, "host string, wrapper string")
    return stage(partly.distinct().groupBy("host").applyInPandas(together, "host string, wrapper string"), "wrappers")


def extract(pages: DataFrame, wrappers: DataFrame | None = None) -> DataFrame:
    """page_id, url, text, n_chars from pages (page_id, url, html): the article's blocks, one a line.

    White space inside a block becomes one space, character references are decoded once, a line break in a block is a
    space. A null html gives the empty text, a page without a host belongs to the nameless host. Other columns are
    not used; repeated rows each give a row; an empty table gives an empty one.
    """
    ship(__name__)
    wrappers = infer(pages) if wrappers is None else wrappers

    def run(frames):
        judged = once("wrappers.judged", "wrappers", dict)
        for frame in frames:
            texts = []
            for page, wrapper in zip(frame["html"], frame["wrapper"], strict=True):
                if len(judged) > _HOSTS_AT_ONCE:
                    judged.clear()
                key = wrapper or "[]"
                if key not in judged:
                    judged[key] = judge(json.loads(key))
                texts.append(main_text(page or "", judged[key]))
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host(F.col("url")).alias("host"))
    return rows.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper").mapInPandas(run, "page_id long, url string, text string, n_chars long")
