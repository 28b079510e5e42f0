"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from goldthread.llm.common import bound_batches, slices, text_of

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
HINT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?。，；：！？、؟]")

# The element kinds of the markup language.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "select"}
#: Those in which a tag of their own name is text, too.
PLAIN_RAW = {"script", "style", "textarea", "title", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "img", "wbr", "embed"}
CLOSED_BY_SIBLING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                     "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Share of the score of content paths that the container of an article without <article> or <main> holds.
MOST = 0.9
#: Share of the best part's score from which an equal part beside it belongs to the same text.
PART = 0.25
#: Elements that never hold the article, by name, and by a word of their class, id or role.
ASIDE_TAGS = {"nav", "footer", "header", "aside", "form", "button", "dialog", "menu", "head"}
ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "header", "masthead",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "search", "share", "sharing", "social", "related", "recommended", "comment", "comments",
    "disqus", "reply", "replies", "respond", "widget", "toolbar", "pagination", "pager", "contentinfo", "complementary",
    "form", "skip", "alert", "copyright", "tags", "hidden"}


@dataclass
class Element:
    tag: str
    label: str
    aside: bool = False
    by_hint: bool = False
    wraps: bool = False
    parent: "Element | None" = None


@dataclass
class Block:
    element: Element
    path: tuple[str, ...]
    text: str
    linked: int
    score: float = field(default=0.0)

    def chain(self):
        at = self.element
        while at is not None:
            yield at
            at = at.parent


def _hints(attributes: str) -> tuple[str, set[str], bool]:
    label, words, hidden = "", set(), False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            words |= {w.lower() for w in HINT.findall(value)}
            if name == "class":
                label = "." + re.sub(r"\d+", "", value.strip().lower())
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        else:
            hidden |= value.lower() != "false"
    return label, words, hidden


def _raw_end(page: str, at: int, tag: str, attributes: str, stack: list[Element]) -> int:
    """Where an element ends whose content is no text of the page; one that is not closed ends with its parent."""
    if tag in ("svg", "math") and attributes.rstrip().endswith("/"):
        return at
    depth = 1
    for found in re.compile(rf"<(/?){tag}\b([^>]*)>", re.I).finditer(page, at):
        if found[1]:
            depth -= 1
        elif tag not in PLAIN_RAW and not found[2].rstrip().endswith("/"):
            depth += 1
        if not depth:
            return found.end()
    if tag in ("script", "style"):
        return len(page)
    ends = [rf"</{re.escape(e.tag)}\b" for e in stack[1:]]
    if stack[-1].tag in CLOSED_BY_SIBLING:
        ends += [rf"<{t}\b" for t in CLOSED_BY_SIBLING[stack[-1].tag]]
    end = re.compile("|".join(ends), re.I).search(page, at) if ends else None
    return end.start() if end else len(page)


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, each with its path of block elements from the root."""
    stack: list[Element] = [Element("", "")]
    blocks: list[Block] = []
    parts: list[str] = []
    links, linked, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            blocks.append(Block(stack[-1], tuple(e.label for e in stack[1:]), text, linked))
        parts.clear()
        linked = 0

    while True:
        found = MARKUP.search(page, at)
        piece = page[at:found.start()] if found else page[at:]
        if piece:
            parts.append(piece)
            if links:
                linked += len(piece)
        if not found:
            break
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        closing = (found[1] or found[4]) == "/"
        if tag == "br":
            parts.append(" ")
        elif tag in RAW and not closing:
            if tag not in INLINE:
                flush()
            at = _raw_end(page, at, tag, found[3] or found[6] or "", stack)
        elif tag == "a":
            links = 0 if closing else 1
        elif tag in INLINE or tag in VOID and tag != "hr":
            continue
        else:
            flush()
            links = 0
            if closing:
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
                if depth:
                    del stack[depth:]
                continue
            if tag == "hr":
                continue
            if stack[-1].tag in CLOSED_BY_SIBLING.get(tag, ()) or stack[-1].tag == "p":
                stack.pop()
                if tag == "tr" and stack[-1].tag == "tr":
                    stack.pop()
            label, words, hidden = _hints(found[3] or found[6] or "")
            hint = tag not in ("html", "body") and bool(words & ASIDE_WORDS)
            in_article = any(e.tag in ("article", "main") for e in stack)
            aside = tag in ASIDE_TAGS and not (tag == "header" and in_article) or hidden
            element = Element(tag, tag + label, aside or hint, hint and not aside, parent=stack[-1])
            stack.append(element)
            if tag in ("h1", "main") or tag == "article" and not hint:
                for e in stack[:-1]:
                    e.wraps = True
    flush()
    return blocks


def _score(blocks: list[Block]) -> None:
    """Fused path ratios: text and punctuation per block of a path, each smoothed over neighbouring blocks."""
    size, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for b in blocks:
        size[b.path] += max(len(b.text) - b.linked, 0)
        marks[b.path] += len(PUNCTUATION.findall(b.text))
        count[b.path] += 1
    kernel = np.exp(-np.arange(-2, 3) ** 2 / 2.0)
    kernel /= kernel.sum()

    def smooth(values: list[float]) -> np.ndarray:
        padded = np.pad(np.array(values, float), 2, mode="edge")
        return np.convolve(padded, kernel, "valid")

    fused = (smooth([size[b.path] / count[b.path] for b in blocks])
             * (1 + smooth([marks[b.path] / count[b.path] for b in blocks])))
    by_path = defaultdict(list)
    for b, s in zip(blocks, fused):
        by_path[b.path].append(s)
    for b in blocks:
        b.score = float(np.mean(by_path[b.path]))


def main_text(page: str, threshold: float = 0.5) -> str:
    """The article of a page: its blocks joined by one space, empty if there is none.

    Blocks under elements that never hold the article are left out first. Paths whose fused ratio reaches
    ``threshold`` standard deviations are content. If some of it is in an article or main part, that with most score is
    kept whole, and so are the parts beside it of the same kind with at least ``PART`` of its score. Otherwise the container is the deepest that holds ``MOST`` of the score, with other blocks on its content
    paths; kept are content paths, headings, and what stands between them and is not mostly links.
    """
    blocks = [b for b in blocks_of(page)
              if not any(e.aside and not (e.by_hint and e.wraps) for e in b.chain())]
    if not blocks:
        return ""
    _score(blocks)
    least = min(threshold * float(np.std([b.score for b in blocks])), max(b.score for b in blocks))
    worth: dict[tuple[int, int], float] = defaultdict(float)
    named: dict[int, float] = defaultdict(float)
    for b in blocks:
        if b.score < least:
            continue
        value = b.score * len(b.text)
        marked = [e for e in b.chain() if e.tag == "article"] or [e for e in b.chain() if e.tag == "main"]
        if marked:
            named[id(marked[-1])] += value
        for depth, e in enumerate(reversed([*b.chain()])):
            worth[depth, id(e)] += value
    if named:
        best = max(named, key=named.get)
        element = {id(e): e for b in blocks for e in b.chain()}
        # Parts of one text: elements of one kind, side by side, that hold content paths too.
        parts = {i for i, value in named.items() if value >= PART * named[best] and element[i].label == element[best].label
                 and element[i].parent is element[best].parent}
        return " ".join(b.text for b in blocks if any(id(e) in parts for e in b.chain()))
    most = MOST * max(worth.values())
    # The children of the deepest such element are the article; one block of text that holds most of it is none.
    _, root = max((k for k, v in worth.items() if v >= most), key=lambda k: k[0])
    root = next(id(e.parent or e) for b in blocks for e in b.chain() if id(e) == root and b.score >= least)
    paths = {b.path for b in blocks if b.score >= least and any(id(e) == root for e in b.chain())}
    inside = [b for b in blocks if b.path in paths or any(id(e) == root for e in b.chain())]
    good = [i for i, b in enumerate(inside) if b.score >= least]
    return " ".join(b.text for i, b in enumerate(inside) if b.element.tag in HEADINGS or b.score >= least
                    or good[0] <= i <= good[-1] and 2 * b.linked <= len(b.text))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id``, ``url``, ``html``).

    A null or empty page, or one without an article, gives the empty text. Null ids and addresses stay
    null; repeated rows are treated each on its own; other columns are ignored; an empty table gives no
    rows. Pages of any length are read whole.
    """
    bound_batches(pages.sparkSession)

    def extract(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(p) for p in text_of(part, "html").to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "page_id": part.column("page_id"), "url": part.column("url"), "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", "html").mapInArrow(
        extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
