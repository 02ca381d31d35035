"""Main text of web pages by the maximum-scoring run of words and tags.

A page becomes a sequence of words (positive score) and tags (negative score). The weights are log odds learned from a
bounded sample of labelled pages: where a page marks one `article` or `main`, the tokens inside it are labelled content
and the others not. One linear scan finds the run of tokens with the largest sum; its words are the text, without those
in parts that are never content.

Such parts are elements that HTML has for them (nav, header, footer, aside, form, script and the like) and hidden ones.
An element that only its class, id or role names so is a part by its evidence: a name for reader comments or adverts
counts by itself; a name for a sidebar, menu or notice counts unless the element wraps all marked content, or most words
of a page that marks none; a name that articles use as well (share, related, header, ...) counts inside marked content
only where half of the words are links. Names of a state (`with-sidebar`, `has-menu`) are no names. Where nothing would
be left, named parts count as content.

Null, empty and markup-only pages give an empty text and n_chars 0. Of runs with equal sums the first wins. An element
that is never closed ends with what it stands in; the raw text of an unclosed script, style, title or frame ends at the
next tag of a block. A tag in which the page was cut off is markup and is dropped. Tags with no word between them cost once, so
tables and lists of short entries hold together. Repeated rows are extracted each; null urls and ids stay null. Without a labelled page DEFAULT
weights are used. Extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, by_chars, table

TRAIN_PAGES = 2_000

# Names of the HTML standard, and words that name page parts in class, id and role attributes.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "object", "canvas")
PARTS = ("nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "label", "head")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
BLOCKS = (
    "address", "article", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "html", "li", "main", "ol", "p", "pre",
    "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", *PARTS[:7],
)
READER_WORDS = (
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "comment", "comments", "disqus", "replies", "reply",
    "respond", "sponsor", "sponsored",
)
PAGE_WORDS = (
    "breadcrumb", "breadcrumbs", "complementary", "consent", "contentinfo", "cookie", "cookies", "footer", "gdpr", "masthead",
    "menu", "modal", "nav", "navbar", "navigation", "newsletter", "pager", "pagination", "popup", "sidebar", "signup",
    "subscribe", "topbar",
)
SHARED_WORDS = (
    "banner", "copyright", "form", "header", "notice", "promo", "promoted", "recommended", "related", "search", "share",
    "sharing", "social", "toolbar", "widget",
)
STATE_WORDS = ("with", "has", "no", "without", "is", "hide", "show")
CONTENT_ROLES = ("article", "main")
# No part of a pattern is tried twice on the same characters. A quote opens a value after an equals sign only, and a tag, comment or
# declaration that nothing closes takes the rest of the page: so a page is read once, wherever it was cut.
_TOKEN = re.compile(
    r"</?\Z|<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)(>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
_NEXT_BLOCK = re.compile(rf"<(?:{'|'.join(x for x in BLOCKS if x not in ('br', 'hr'))})[\s/>]", re.I)
_RAW_END = {x: re.compile(rf"</{x}\s*>", re.I) for x in RAW}

#: Start tags that end an open head.
BLOCKS_OF_BODY = frozenset(BLOCKS) - {"html", "head"}

DEFAULT = {"word": 1.0, "link": -0.5, "block": -0.45, "inline": -0.1, "part": -1.0}
#: Kinds of tokens that are text: plain, and in a link.
TEXT = ("word", "link")
_STRENGTH = {"inline": 0, "block": 1, "part": 2}
#: The most that a tag may cost, in words: a word outweighs the two tags of a block around it.
MOST = {"block": 0.45, "inline": 0.1, "part": 2.0}


_WORDS = ((frozenset(READER_WORDS), "reader"), (frozenset(PAGE_WORDS), "page"), (frozenset(SHARED_WORDS), "shared"))
_BLOCK_SET, _VOID_SET = frozenset(BLOCKS), frozenset(VOID)


def part_kind(name: str, attrs: str) -> str | None:
    """always, reader, page or shared for an element that may be a part of no content, else None."""
    if name in PARTS:
        return "always"
    if name in ("html", "body") or not attrs:
        return None
    found = set()
    for key, *values in _ATTR.findall(attrs):
        value, key = "".join(values), key.lower()
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            return "always"
        if key in ("class", "id", "role"):
            for token in value.split():
                words = [x.lower() for x in _SPLIT.split(token) if x]
                if words and words[0] not in STATE_WORDS:
                    found.update(kind for names, kind in _WORDS if not names.isdisjoint([*words, *(x for x in re.split(r"[^a-z0-9]+", token.lower()) if x)]))
    if name in CONTENT_ROLES:
        return "reader" if "reader" in found else None
    return next((kind for _, kind in _WORDS if kind in found), None)


class _Part:
    """An element that a name makes a part, and what is in it. up: the part around it, -1 for none."""

    def __init__(self, kind: str, up: int, marked: bool):
        self.kind, self.up, self.marked = kind, up, marked
        self.words = self.linked = self.in_mark = 0

    def drops(self, words: int, in_mark: int) -> bool:
        if self.kind == "reader":
            return True
        if self.in_mark == in_mark > 0 and not self.marked or not in_mark and 2 * self.words > words:
            return False
        return not (self.kind == "shared" and self.marked and 2 * self.linked < self.words)


def tokens(page: str) -> tuple[list[tuple[str, str, bool]], list[bool]]:
    """(kind, text, outside) of each token, and whether it stands in the page's marked content.

    kind: word or link for text (raw, with its white space), block, inline or part for tags. outside: in a part that is no content.
    """
    found: list[tuple[str, str, bool, int, bool]] = []  # kind, text, always outside, part, in a mark
    named: list[_Part] = []
    stack: list[tuple[str, bool, int]] = []  # name, whether it is always outside, the part that it is or -1
    opened: Counter = Counter()  # names on the stack
    unclosed: set[str] = set()  # raw elements that nothing closes from here on
    always = marked = links = 0
    here = -1
    at, end = 0, len(page)

    def add(kind: str, text: str) -> None:
        found.append(("link" if kind == "word" and links else kind, text, always > 0, here, marked > 0))
        if kind == "word" and not always and here >= 0:
            n, x = len(text.split()), named[here]
            x.words, x.linked, x.in_mark = x.words + n, x.linked + n * (links > 0), x.in_mark + n * (marked > 0)

    def pop() -> None:
        nonlocal always, marked, links, here
        name, out, part = stack.pop()
        opened[name] -= 1
        always -= out
        links -= name == "a"
        marked -= name in CONTENT_ROLES and part < 0
        if part >= 0:
            here = named[part].up

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add("word", page[at:])
            break
        if m.start() > at:
            add("word", page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        if not m[4]:  # the page was cut in this tag
            break
        name = m[2].lower()
        if not m[1]:
            if name in _RAW_END:
                if not m[3].endswith("/"):
                    close = None if name in unclosed else _RAW_END[name].search(page, at)
                    if close is None:
                        unclosed.add(name)
                    block = None if close else _NEXT_BLOCK.search(page, at)
                    at = close.end() if close else block.start() if block else end
                continue
            kind = part_kind(name, m[3])
            if name == "body" or name in BLOCKS_OF_BODY and stack and stack[-1][0] == "head":
                while opened["head"]:
                    pop()
            if name not in _VOID_SET:
                part = -1
                if kind not in (None, "always"):
                    named.append(_Part(kind, here, marked > 0))
                    part = here = len(named) - 1
                stack.append((name, kind == "always", part))
                opened[name] += 1
                always += kind == "always"
                links += name == "a"
                marked += name in CONTENT_ROLES and part < 0
            add("part" if kind else "block" if name in _BLOCK_SET else "inline", "")
        else:
            if opened[name]:
                # a block's end closes what is open in it; an inline end never closes a block
                while stack[-1][0] != name:
                    if name not in _BLOCK_SET and stack[-1][0] in _BLOCK_SET:
                        break
                    pop()
                if stack[-1][0] == name:
                    pop()
            add("block" if name in _BLOCK_SET else "inline", "")
    for x in reversed(named):  # what is in a part is in those around it, which come before it
        if x.up >= 0:
            up = named[x.up]
            up.words, up.linked, up.in_mark = up.words + x.words, up.linked + x.linked, up.in_mark + x.in_mark
    return _settled(found, named)


def _settled(found: list[tuple[str, str, bool, int, bool]], named: list[_Part]) -> tuple[list[tuple[str, str, bool]], list[bool]]:
    """Which tokens are outside, once all parts are known by their words."""
    sizes = [len(text.split()) if kind in TEXT and not out else 0 for kind, text, out, _, _ in found]
    words, in_mark = sum(sizes), sum(n for n, x in zip(sizes, found, strict=True) if x[4])
    gone: list[bool] = []
    for part in named:  # what is around a part comes before it
        gone.append(part.up >= 0 and gone[part.up] or part.drops(words, in_mark))
    if words and not any(n for n, x in zip(sizes, found, strict=True) if x[3] < 0 or not gone[x[3]]):
        gone = [False] * len(named)
    out = [(kind, text, always or part >= 0 and gone[part]) for kind, text, always, part, _ in found]
    return out, [x[4] for x in found]


def charged(found: list[tuple[str, str, bool]]) -> list[str | None]:
    """What each token counts as: text as itself, and a run of tags with no word between as one, the strongest of them, at its
    first tag. A cell of a table is no further from the next than a paragraph is, however many tags stand between."""
    out: list[str | None] = []
    run = -1  # where the run began
    for kind, text, outside in found:
        if kind in TEXT:
            out.append(kind)
            if text.strip():
                run = -1
            continue
        kind = "block" if outside else kind
        if run < 0:
            run = len(out)
            out.append(kind)
        else:
            out[run] = max(out[run], kind, key=_STRENGTH.get)
            out.append(None)
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end (exclusive) of the contiguous run with the largest sum; (0, 0) if no score is positive."""
    best = total = 0.0
    start = a = b = 0
    for i, x in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += x
        if total > best:
            best, a, b = total, start, i + 1
    return a, b


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The main text of one page."""
    if not page:
        return ""
    found, inside = tokens(page)
    # what is never content neither helps nor breaks a run: it is left out of the text
    scores = [0.0 if kind is None or kind in TEXT and outside else weights[kind] * (len(text.split()) if kind in TEXT else 1) for kind, (_, text, outside) in zip(charged(found), found, strict=True)]
    if any(m and k in TEXT and not o and t.strip() for (k, t, o), m in zip(found, inside, strict=True)):
        # a page that marks its content: words inside count for a run, tags hardly, and what stands outside counts against it
        scores = [abs(s) if m and k in TEXT else s / 50 if m else -abs(s) for s, m, (k, *_) in zip(scores, inside, found, strict=True)]
    a, b = best_run(scores)
    kept = [" " if kind in ("block", "part") else html.unescape(text) if kind in TEXT else "" for kind, text, outside in found[a:b] if not outside or kind not in TEXT]
    return " ".join("".join(kept).split())


def train(pages: DataFrame, rows: int = TRAIN_PAGES) -> dict[str, float]:
    """Log odds of content for words and each kind of tag, from a bounded sample of pages that mark their content."""
    sample = bounded_sample(pages.where(F.col("html").isNotNull() & F.lower("html").rlike("<(article|main)[\\s>]")), "page_id", rows)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: Counter = Counter()
        for pdf in by_chars(batches, "html"):
            for page in pdf["html"]:
                found, inside = tokens(page)
                for kind, (_, text, outside), m in zip(charged(found), found, inside, strict=True):
                    if kind:
                        sums[kind, m and not outside] += len(text.split()) if kind in TEXT else 1
        yield pd.DataFrame([(k, m, n) for (k, m), n in sums.items()], columns=["kind", "content", "n"])

    got = {(r["kind"], r["content"]): r["n"] for r in sample.select("html").mapInPandas(count, "kind string, content boolean, n long").groupBy("kind", "content").agg(F.sum("n").alias("n")).collect()}
    if not any(m for _, m in got):
        return dict(DEFAULT)
    kinds = list(DEFAULT)
    total = {m: sum(got.get((k, m), 0) + 1 for k in kinds) for m in (True, False)}
    odds = {k: math.log((got.get((k, True), 0) + 1) / total[True]) - math.log((got.get((k, False), 0) + 1) / total[False]) for k in kinds}
    word = max(0.25, odds["word"])
    return {"word": word, "link": min(word, max(-word, odds["link"])), **{k: min(-0.05 * word, max(-most * word, odds[k])) for k, most in MOST.items()}}


def main_text(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in by_chars(batches, "html"):
            texts = [extract(x, weights) for x in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(x) for x in texts]})

    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", F.col("html").cast("string").alias("html"))
    return rows.mapInPandas(run, "page_id string, url string, text string, n_chars long").withColumn("page_id", F.col("page_id").cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: all pages."""
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, train(pages))
