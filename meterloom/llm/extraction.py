"""Main text of raw pages by two-pass block rules.

The page is cut into blocks at block-level tags. The first pass decides a block by its place
(menus, footers, forms, adverts and the like; headings), its link density, its length and the
share of stop words in it; short blocks in between stay open. The second pass lets an open block
inherit from its nearest decided neighbours: good if both sides are good or the nearer one is.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a an and are as at be by for from has have in is it its of on or that the this to was were which will with "
    "auf aus bei das dem den der des die ein eine einer es für im in ist mit nicht sich sie sind und von wird zu "
    "au aux avec ce dans de des du elle en est et il la le les ou par pas pour que qui se sur un une "
    "al como con de del el en es la las lo los más no para por que se su un una y".split()
)
#: Elements whose whole content is never text.
_SILENT = {"script", "style", "template", "noscript", "svg", "iframe", "head", "select", "textarea", "button", "object", "canvas"}
#: Elements that hold a page's furniture.
_FURNITURE = {"nav", "footer", "aside", "form", "menu", "dialog"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "source", "wbr", "area", "base", "col", "embed", "track", "param"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
    "u", "var", "wbr",
}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words of a class or id that name furniture, and words that may stand beside them in one name.
_BAD_WORD = re.compile(
    r"(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumbs?|sidebar|side|footer|masthead|"
    r"siteheader|pageheader|header|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|signup|login|search|"
    r"share|sharing|social|related|recommend\w*|comments?|replies|reply|respond|disqus|widget|pagination|pager|toolbar|"
    r"copyright|legal|disclaimer|skip)\d*"
)
_BESIDE = re.compile(
    r"(?:site|main|global|primary|secondary|top|bottom|left|right|inner|outer|bar|box|area|block|section|list|links?|items?|"
    r"form|container|wrapper|slot|unit|posts?|articles?|stories|title|buttons?|icons?|media|to|policy|\d*)\d*"
)
_BAD_ROLE = re.compile(r"\b(?:navigation|banner|contentinfo|complementary|search|form|dialog|alert|menu)\b", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
#: What a head may hold, its end, and what ends it where its end tag is left out.
_HEAD = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|title|object)\b.*?</\1\s*>|(?P<end></head\b[^>]*(?:>|\Z))|"
    r"(?P<other><(?!(?:meta|link|base)\b)[a-zA-Z])",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"\s+")


@dataclass
class Rules:
    """Limits of the first pass: lengths in characters, shares between 0 and 1."""

    short: int = 70
    long: int = 200
    stop_low: float = 0.08
    stop_high: float = 0.2
    links: float = 0.4


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    bad: bool
    article: bool
    named: bool  # bad by the name of an element only


def _bad_name(value: str) -> bool:
    """Whether one of the names is made of furniture words alone: ``cookie-notice``, not ``with-sidebar``."""
    for name in value.lower().split():
        parts = re.split(r"[-_]+", name)
        if len(parts) > 1 and parts[0] == "page":  # page-header, but search-page is a page
            parts = parts[1:]
        found = [_BAD_WORD.fullmatch(p) is not None for p in parts]
        if any(found) and all(f or _BESIDE.fullmatch(p) for f, p in zip(found, parts, strict=True)):
            return True
    return False


def _is_bad(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _FURNITURE or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value = a or b or c
        low = name.lower()
        if low == "role" and _BAD_ROLE.search(value):
            return True
        if low == "hidden" or (low == "aria-hidden" and value.lower() == "true"):
            return True
        if low == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def _is_named(tag: str, attributes: str) -> bool:
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    return any(name.lower() in ("class", "id") and _bad_name(a or b or c) for name, a, b, c in _ATTRIBUTE.findall(attributes))


def blocks(page: str) -> list[Block]:
    """Text blocks in page order; white space is one space, references are decoded."""
    out: list[Block] = []
    open_: list[tuple[str, bool, bool]] = []  # tag, furniture, furniture by name
    names: list[list[bool]] = []  # of the open elements named as furniture, whether they hold an article
    inside: list[list[bool] | None] = []  # of each block, its innermost such element
    bad = articles = links = headings = 0
    parts: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            out.append(Block(text, linked, headings > 0, bad > 0, articles > 0, False))
            inside.append(names[-1] if names else None)
        parts.clear()
        linked = 0

    def words(raw: str) -> None:
        nonlocal linked
        if raw:
            parts.append(raw)
            if links:
                linked += len(_SPACE.sub(" ", html.unescape(raw)).strip())

    def leave(tag: str, is_bad: bool, is_named: bool) -> None:
        nonlocal bad, articles, links, headings
        bad -= is_bad
        if is_named:
            names.pop()
        articles -= tag in ("article", "main")
        links -= tag == "a"
        headings -= tag in _HEADINGS

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            rest = page[at:]
            cut = re.search(r"</?[a-zA-Z!?]?[^<>]*\Z", rest)  # a tag that the page's end cut off
            words(rest[: cut.start()] if cut and re.match(r"</|<[a-zA-Z!?]|<\Z", cut[0]) else rest)
            break
        words(page[at : m.start()])
        at = m.end()
        tag = m[2].lower() if m[2] else ""
        if not tag:
            continue
        if m[1]:
            if tag not in _INLINE:
                close()
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == tag:
                    for item in reversed(open_[k:]):
                        leave(*item)
                    del open_[k:]
                    break
            continue
        if tag in _SILENT:
            if tag == "head":
                stop = next((h for h in _HEAD.finditer(page, at) if h["end"] or h["other"]), None)
                at = size if stop is None else stop.end() if stop["end"] else stop.start()
            elif not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
            if tag not in _INLINE:
                close()
            continue
        if tag in _VOID:
            if tag == "br":
                parts.append(" ")
            elif tag == "hr":
                close()
            continue
        if tag not in _INLINE:
            close()
        if tag in ("p", "li", "dt", "dd", "option", "tr", "td", "th"):  # their end tags may be left out
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == tag and all(t in _INLINE for t, *_ in open_[k + 1 :]):
                    for item in reversed(open_[k:]):
                        leave(*item)
                    del open_[k:]
                    break
                if open_[k][0] not in _INLINE:
                    break
        if m[3].endswith("/") and tag not in ("p", "div"):
            continue
        is_bad = _is_bad(tag, m[3], articles > 0)
        is_named = _is_named(tag, m[3])
        open_.append((tag, is_bad, is_named))
        bad += is_bad
        if is_named:
            names.append([False])
        if tag in ("article", "main"):
            for holds in reversed(names):
                if holds[0]:
                    break
                holds[0] = True
        articles += tag in ("article", "main")
        links += tag == "a"
        headings += tag in _HEADINGS
    close()
    # An element that holds an article is no furniture, whatever its name, nor are those around it.
    for block, holds in zip(out, inside, strict=True):
        block.named = holds is not None and not holds[0]
    return out


def first_pass(block: Block, whole_article: bool, rules: Rules) -> str:
    """good, bad or open."""
    if block.bad or (whole_article and not block.article):
        return "bad"
    size = len(block.text)
    if block.linked / size > rules.links and not block.heading:
        return "bad"
    stop = [w.strip(".,;:!?%*#&$|()\"'").lower() in STOP_WORDS for w in block.text.split()]
    density = sum(stop) / len(stop)
    if size >= rules.long:
        return "good" if density >= rules.stop_low or block.article else "bad"
    if size >= rules.short and density >= rules.stop_high:
        return "good"
    return "open"


def second_pass(found: list[Block], kinds: list[str]) -> list[bool]:
    """Open blocks take the label of the nearest decided block; of two as near, and where
    nothing is decided, a block of an article is good, a heading follows what comes after it."""
    n = len(kinds)
    before, after = [None] * n, [None] * n
    last = None
    for i in range(n):
        before[i] = last
        if kinds[i] != "open":
            last = i
    last = None
    for i in range(n - 1, -1, -1):
        after[i] = last
        if kinds[i] != "open":
            last = i
    out = []
    for i, kind in enumerate(kinds):
        if kind != "open":
            out.append(kind == "good")
            continue
        a, b = before[i], after[i]
        near = {kinds[k] for k in (a, b) if k is not None}
        if found[i].article:  # inside the article only furniture can be the bad neighbour
            out.append("good" in near or all(k is None or found[k].bad or not found[k].article for k in (a, b)))
        elif not near:
            out.append(False)
        elif len(near) == 1:
            out.append("good" in near)
        elif found[i].heading:
            out.append(kinds[b] == "good")
        else:
            out.append(kinds[a if i - a < b - i else b if b - i < i - a else a] == "good" and i - a != b - i)
    return out


def main_text(page: str | None, rules: Rules) -> str:
    found = blocks(page or "")
    named = [b for b in found if b.named and not b.bad]
    for b in named:
        b.bad = True
    text = _chosen(found, rules)
    if not text and named:  # names alone do not empty a page: the other rules decide
        for b in named:
            b.bad = False
        text = _chosen(found, rules)
    return text


def _chosen(found: list[Block], rules: Rules) -> str:
    whole = any(b.article and not b.bad for b in found)
    kinds = [first_pass(b, whole, rules) for b in found]
    return "\n".join(b.text for b, good in zip(found, second_pass(found, kinds), strict=True) if good)


def _pages(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p.as_py(), rules) for p in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, rules: Rules | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``: a row per row of ``pages``, from the whole html.

    Null and empty pages, and pages without main text, have an empty text. Pages that break off
    keep what came before; end tags may be missing. Repeated rows, null ids and urls stay as
    they are, other columns are ignored. No rows, no rows.
    """
    rules = rules or Rules()
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    ).mapInArrow(lambda b: _pages(b, rules), "page_id long, url string, text string, n_chars long")
