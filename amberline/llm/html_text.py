"""Main text of web pages, with removal of site templates.

The subtrees of each page's elements are hashed by tag, text and structure and counted per host in
Spark; those that recur on pages of many different main texts of a host are its template and are
deleted, so copies of a page count once. Where they hold most of a page's text, the pages are near copies,
not a template, and stay whole. Elements whose tag, role or class names a menu, footer, form, advert or the
like go as well, which also covers hosts of few pages; never the body, an article, what holds one, or, where
there is none, what holds most of the text. Of what is left, the article (or the main element, or else all)
is the text.
"""

from __future__ import annotations

import hashlib
import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amberline.llm.common import saved, texts

#: A subtree on pages of so many different texts of a host, and of this share of them, is its template.
#: By number alone, short cells and list items that recur by chance would be template on every large host.
LEAST_PAGES, LEAST_SHARE = 10, 0.01
#: Elements that together hold this share of a page's text are no template there; near copies share as much.
#: On a page without an article, what holds as much of the text does not go by its tag or class.
MOST = 0.8

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z][^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z0-9]+")
# Element names of HTML by their role here; fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
DROPPED = frozenset("head title script style noscript template nav footer aside form button select option input textarea iframe object embed svg canvas audio video map dialog menu".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar dialog alertdialog".split())
# Words in class and id attributes that name parts of a page other than its text.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs masthead topbar "
    "footer sidebar sidebars widget widgets cookie cookies consent gdpr notice notices banner alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comment comments disqus reply replies respond toolbar pagination pager skip".split()
)


# Words that beside one of these change nothing about it, and words that turn it round.
PLAIN_WORDS = frozenset(
    "area bar block body bottom box btn button buttons center col column container content div footer form group header icon icons inner item items label left link links list main "
    "message module outer page panel placeholder post posts right row section site slot spot text title top unit user wrap wrapper zone".split()
)
TURNING_WORDS = frozenset("no non not without with has have is hide hides hidden off show shows".split())
HEADERS = frozenset("header site-header page-header global-header top-header".split())
WHOLE = frozenset("html body article main".split())
#: Dropped unless they hold an article or most of the text: pages stand in one form on some sites.
HOLDING = frozenset("form aside dialog".split())


class Element:
    __slots__ = ("tag", "attributes", "children", "dropped", "named", "mark", "size")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children, self.mark, self.size = tag, attributes, [], None, 0
        self.dropped = tag in DROPPED and tag not in HOLDING
        self.named = tag in HOLDING
        if attributes and not self.dropped:
            self.dropped, self.named = (_known_fate if len(attributes) <= SHORT else _fate)(tag, attributes)


def _fate(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is hidden, and whether its tag or attributes name a part other than the text."""
    other = _is_other(attributes)
    named = tag not in WHOLE and (tag in HOLDING or other) or tag in ("article", "main") and other and _is_comment(attributes)
    return _is_hidden(attributes), named


#: Pages repeat their short attributes; those of up to so many characters are judged once while they are remembered.
SHORT = 200
_known_fate = lru_cache(1 << 14)(_fate)


def _tokens(attributes: str):
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            yield from "".join(values).lower().split()


def _is_hidden(attributes: str) -> bool:
    found = [(name.lower(), "".join(values).lower()) for name, *values in _ATTRIBUTE.findall(attributes)]
    return any(name == "hidden" or name == "aria-hidden" and value == "true" for name, value in found)


def _is_name(token: str) -> bool:
    """Whether one class or id names a part other than the text: a name, alone, last, or among plain words."""
    words = _NAME.findall(token)
    if NAMES.isdisjoint(words) or not TURNING_WORDS.isdisjoint(words):
        return False
    return words[-1] in NAMES or all(w in NAMES or w in PLAIN_WORDS or w.isdigit() or len(w) == 1 for w in words)


def _is_other(attributes: str) -> bool:
    roles = ("".join(values).lower().strip() for name, *values in _ATTRIBUTE.findall(attributes) if name.lower() == "role")
    return any(role in ROLES for role in roles) or any(_is_name(token) for token in _tokens(attributes))


def _is_comment(attributes: str) -> bool:
    """Readers' comments are articles on some sites."""
    return any(token in ("comment", "reply") for token in _tokens(attributes))


# Which open elements end an element of a kind, and which hide them from it.
_ENDED = {"p": ({"p"}, frozenset(("table", "td", "th", "li", "div", "article", "section", "blockquote", "body", "main")))}
_ENDED |= {tag: (CLOSES[tag], SCOPE[tag]) for tag in CLOSES}


class _Open:
    """The open elements; where the next one to close stands is known without a search."""

    def __init__(self, root: Element):
        self.elements, self.places, self.near = [root], {}, [dict.fromkeys(_ENDED, 0)]

    def push(self, element: Element) -> None:
        tag, depth = element.tag, len(self.elements)
        self.places.setdefault(tag, []).append(depth)
        above = self.near[-1]
        if tag in _CHANGES:
            ended, hidden = _CHANGES[tag]
            above = above | dict.fromkeys(ended, depth) | hidden
        self.near.append(above)
        self.elements.append(element)

    def cut(self, depth: int) -> None:
        """Close the element at a depth and all in it; the root stays."""
        for element in self.elements[depth:]:
            self.places[element.tag].pop()
        del self.elements[depth:], self.near[depth:]

    def end(self, tag: str) -> None:
        if self.places.get(tag):
            self.cut(self.places[tag][-1])

    def make_room(self, kind: str) -> None:
        if self.near[-1][kind]:
            self.cut(self.near[-1][kind])


# By tag, the kinds that end such an element, and those that it hides older ones from.
_CHANGES = {
    tag: ([kind for kind, (tags, _) in _ENDED.items() if tag in tags], {kind: 0 for kind, (tags, scope) in _ENDED.items() if tag in scope - tags})
    for tag in frozenset().union(*(tags | scope for tags, scope in _ENDED.values()))
}


def parse(source: str) -> Element:
    """A tree of elements and text. Unclosed and wrongly nested elements are closed as browsers mostly do."""
    root = Element("html")
    stack, at, end = _Open(root), 0, len(source)
    while at < end:
        found = _TOKEN.search(source, at)
        if not found:
            break
        if found.start() > at:
            stack.elements[-1].children.append(source[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            stack.end(tag)
            continue
        if tag in ("html", "body", "head") and any(x.tag == tag for x in stack.elements[: 2 if tag != "html" else 1]):
            continue
        if tag in ENDS_PARAGRAPH:
            stack.make_room("p")
        if tag in CLOSES:
            stack.make_room(tag)
        if tag == "body":
            stack.cut(1)
        attributes = found[3] if found[2] else found[6]
        element = Element(tag, attributes or "")
        stack.elements[-1].children.append(element)
        if tag in RAW:
            closing = re.compile(rf"</{tag}[\s/>]", re.I).search(source, at)
            at = closing.start() if closing else end
            closed = source.find(">", at)
            at = closed + 1 if closing and closed >= 0 else end
        elif tag not in VOID and not (attributes or "").endswith("/"):
            stack.push(element)
    if at < end:
        stack.elements[-1].children.append(source[at:])
    _settle(root)
    return root


def _settle(root: Element) -> None:
    """Decide what goes by its tag or class, from the whole page: sizes first, then the rest from the top."""
    order, waiting = [], [root]
    while waiting:
        element = waiting.pop()
        order.append(element)
        waiting += [x for x in element.children if not isinstance(x, str) and not x.dropped]
    holds: dict[int, bool] = {}
    for element in reversed(order):
        below = [x for x in element.children if not isinstance(x, str) and not x.dropped]
        element.size = sum(len(x.strip()) for x in element.children if isinstance(x, str)) + sum(x.size for x in below)
        holds[id(element)] = any(holds[id(x)] or _is_holder(x) and not x.named for x in below)
    alone = not holds[id(root)]
    waiting = [root]
    while waiting:
        element = waiting.pop()
        if element is not root:
            header = alone and (element.tag == "header" or not HEADERS.isdisjoint(_tokens(element.attributes)))
            most = alone and element.size >= MOST * root.size
            element.dropped |= (element.named or header) and not holds[id(element)] and not (most and not _is_comments(element))
        waiting += [x for x in element.children if not isinstance(x, str) and not x.dropped]


def _is_comments(element: Element) -> bool:
    return not {"comment", "comments", "replies", "disqus"}.isdisjoint(w for token in _tokens(element.attributes) if _is_name(token) for w in _NAME.findall(token))


def _is_holder(element: Element) -> bool:
    return element.tag in ("article", "main") or "main" in element.attributes and bool(re.search(r"role\s*=\s*[\"']?main", element.attributes))


def contents(root: Element) -> list[Element]:
    """The elements that hold a page's text: its articles, else its main element, else all."""
    for kind in ("article", "main"):
        found, waiting = [], [root]
        while waiting:
            element = waiting.pop()
            if element.tag == kind or kind == "main" and _is_holder(element):
                found.append(element)
            else:
                waiting += [x for x in reversed(element.children) if not isinstance(x, str) and not x.dropped]
        if found:
            return found
    return [root]


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def mark(root: Element, roots: list[Element]) -> list[int]:
    """Hash the subtrees that a template may own, and return their hashes; count the characters of text in each element.

    Not hashed are inline elements, those without text, the elements that hold the page's text and
    all around them, and, inside an article, paragraphs, headings and the like: articles may quote
    one passage.
    """
    holders = {id(x) for x in roots}
    article = roots[0] is not root
    out: list[int] = []

    def walk(element: Element, inside: bool) -> tuple[str, bool]:
        holder, element.size = id(element) in holders, 0
        parts = []
        for child in element.children:
            if isinstance(child, str):
                parts.append(" ".join(child.split()))
                element.size += len(parts[-1])
            else:
                text, around = walk(child, inside or holder)
                holder |= around
                element.size += 0 if child.dropped else child.size
                parts.append(text)
        content = "\x01".join(p for p in parts if p)
        if content and not holder and element.tag not in INLINE and not (article and inside and element.tag in PROSE):
            name = f"<{element.tag}>{content}</>"
            element.mark = _hash(name)
            out.append(element.mark)
            return f"<{element.tag} {element.mark}>", holder
        return f"<{element.tag}>{content}</>" if content else "", holder

    _deep(walk, root)
    return out


def _deep(walk, root: Element) -> None:
    """Run a recursive walk with room for deeply nested pages."""
    import sys
    import threading

    depth, front = 0, [root]
    while front:
        front = [x for e in front for x in e.children if not isinstance(x, str)]
        depth += 1
    if depth < 300:
        walk(root, False)
        return
    before, room = sys.getrecursionlimit(), threading.stack_size(min(1 << 30, 64 << 20))
    sys.setrecursionlimit(depth * 3 + 1000)
    try:
        thread = threading.Thread(target=walk, args=(root, False))
        thread.start()
        thread.join()
    finally:
        sys.setrecursionlimit(before)
        threading.stack_size(room)


def extract(source: str, template: frozenset[int] | set[int] = frozenset()) -> str:
    """The text of a page without the subtrees of its site's template.

    Where these together hold ``MOST`` of the text, or no text would be left, all stays.
    """
    root = parse(source)
    roots = contents(root)
    if template:
        mark(root, roots)
        if _owned(roots, template) < MOST * sum(x.size for x in roots):
            return _text(roots, template) or _text(roots)
    return _text(roots)


def _owned(roots: list[Element], template: frozenset[int] | set[int]) -> int:
    """Characters in subtrees of the template."""
    total, waiting = 0, list(roots)
    while waiting:
        element = waiting.pop()
        if element.mark is not None and element.mark in template:
            total += element.size
        else:
            waiting += [x for x in element.children if not isinstance(x, str) and not x.dropped]
    return total


def _text(roots: list[Element], template: frozenset[int] | set[int] = frozenset()) -> str:
    blocks: list[str] = []
    line: list[str] = []

    def flush():
        if not line:
            return
        text = " ".join(html.unescape("".join(line)).split())
        line.clear()
        if text:
            blocks.append(text)

    for top in roots:
        waiting: list = [top]
        while waiting:
            x = waiting.pop()
            if isinstance(x, str):
                line.append(x)
                continue
            if x is None:
                flush()
                continue
            if x.dropped and x is not top or x.mark is not None and x.mark in template:
                line.append(" ")
                continue
            if x.tag not in INLINE:
                flush()
                waiting.append(None)
            waiting += reversed(x.children)
        flush()
    return " ".join(blocks)


def _keyed(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)", 1))
    return pages.select("page_id", "url", "html", host.alias("host"), F.xxhash64("page_id", "url", "html").alias("page"))


def template_marks(keyed: DataFrame, least_pages: int, least_share: float) -> DataFrame:
    """``page, marks``: the hashes of each page's subtrees that are its host's template; pages without any are left out.

    Pages of a host with the same main text, before templates go, count once. Each page has one row
    with a null mark, for the number of its host's texts. Only subtrees of enough pages are counted by texts.
    """

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                rows = batch.slice(low, 500)
                found, main = [], []
                for source in texts(rows.column(2)):
                    root = parse(source)
                    roots = contents(root)
                    found.append(np.unique(np.array(mark(root, roots), np.int64)))
                    main.append(_hash(_text(roots)))
                at = pa.array(np.concatenate([np.arange(len(found)), np.repeat(np.arange(len(found)), [len(x) for x in found])]))
                marks = pa.concat_arrays([pa.nulls(len(found), pa.int64()), pa.array(np.concatenate(found))])
                yield pa.RecordBatch.from_arrays([rows.column(0).take(at), rows.column(1).take(at), pa.array(main, pa.int64()).take(at), marks], ["page", "host", "main", "mark"])

    marks = saved(keyed.select("page", F.xxhash64("host").alias("host"), "html").mapInArrow(run, "page long, host long, main long, mark long"), "marks")
    sizes = marks.where("mark IS NULL").groupBy("host").agg(F.countDistinct("main").alias("texts"))
    often = marks.where("mark IS NOT NULL").groupBy("host", "mark").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    rows = saved(marks.join(often.select("host", "mark"), ["host", "mark"]), "frequent-marks")
    often = rows.groupBy("host", "mark").agg(F.countDistinct("main").alias("n")).where(F.col("n") >= least_pages)
    often = often.join(sizes, "host").where(F.col("n") >= F.col("texts") * least_share).select("host", "mark")
    return rows.join(often, ["host", "mark"]).groupBy("page").agg(F.collect_set("mark").alias("marks"))


def extract_pages(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """The main text of every row of ``pages`` (``page_id, url, html``): ``page_id, url, text, n_chars``.

    A null ``html`` is an empty page with an empty text. Pages with a null or odd ``url`` share the
    host "". Null ids and repeated rows pass through; rows of one main text count as one page of a template.
    An empty table gives an empty result.

    A page's own marks are bounded by its elements. Host and template counts are partial
    aggregates; hot hosts and templates meet only in joins that adaptive execution splits.
    """
    keyed = _keyed(pages)
    marks = template_marks(keyed, least_pages, least_share)

    def run(batches):
        for batch in batches:
            found = [extract(source, frozenset(marks or ())) for source, marks in zip(texts(batch.column(2)), batch.column(3).to_pylist(), strict=True)]
            counts = pa.array([len(text) for text in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), counts], ["page_id", "url", "text", "n_chars"])

    rows = keyed.join(marks, "page", "left").select("page_id", "url", "html", "marks")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
