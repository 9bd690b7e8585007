"""Main text of web pages as a maximum-scoring subsequence of words and tags.

A page is one sequence of tokens: words, which score positive, and tags, which score
negative.  A word's weight depends on the element it stands in and a tag's on its name;
both are log-odds of being inside the article, learned from pages that mark theirs with
``article`` or ``main``, and kept to their sign.  One linear scan finds the contiguous
region with the largest sum.  Elements that are never article text (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) score
nothing and are left out of the region's text; a tag's name, its role or ``hidden`` say so
at once.  A class or id is weighed: the share of its words that name such parts lowers
the weight of all words in the element, and an element whose words then weigh less than
nothing is left out, unless it holds most words of the page.  One whose name leaves no
doubt (comments, cookies, adverts, menus, sidebars and the like) is left out at any size.
None is that holds the marked article.  The text keeps every block of the region: character references decoded, white
space made one space, blocks joined by a newline.

Bounds.  Weights are learned from ``MAX_PAGES`` marked pages of at most ``MAX_CHARS``
characters, or all if there are fewer, drawn by a hash of the id at a rate that comes from
their count.  Extraction is one narrow scan of whole pages, without a shuffle.

Cases.  Null, empty and wordless pages give the empty text.  Unclosed tags, comments and
elements end with their parent or the page.  Without marked pages the default weights
hold.  Ties go to the earlier, then to the longer region."""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_from_text

MAX_PAGES = 600
MAX_CHARS = 100_000
WORD, TAG, LEFT_OUT = 1.0, -0.25, -2.0
_INLINE_COST = -0.02
#: Added to a word's weight if its element's class and id name nothing but such parts.
NAMED = -1.8

_TOKEN = re.compile(r"<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)

# HTML element groups and the words that name parts that aren't article.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = RAW | frozenset("head nav header footer aside form button select option svg math canvas object audio video menu dialog datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output picture progress q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split()
)
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CONTAINERS = frozenset("article aside blockquote body details div dl fieldset figure footer form header html li main nav ol section table tbody td tfoot th thead tr ul".split())
NOT_ARTICLE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: Of these, the words that leave no doubt, and among them those of reader comments.
COMMENTS = frozenset("comment comments commentlist disqus replies".split())
SURE = COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising adsense breadcrumb breadcrumbs consent cookie cookies footer gdpr masthead menu menus modal nav navbar navigation newsletter pager pagination popup promo promoted promotion sharing sidebar signup social sponsor sponsored subscribe".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
#: Words of a class or id that say nothing of its content, and those that deny the next.
NEUTRAL = frozenset("area block body bottom box col column container content inner item items left link links list main outer page panel right section site slot top unit wrap wrapper".split())
DENIES = frozenset("has hide hides no non not off with without".split())
_PARTS = re.compile(r"[a-z]+")


@dataclass
class Weights:
    words: dict[str, float] = field(default_factory=dict)  # innermost block element -> weight
    tags: dict[str, float] = field(default_factory=dict)  # tag name -> weight

    def word(self, element: str) -> float:
        return self.words.get(element, WORD)

    def tag(self, name: str) -> float:
        return self.tags.get(name, _INLINE_COST if name in INLINE else TAG)


def _left_out(name: str, attributes: str) -> tuple[bool, float, bool]:
    """Whether the element is never article text, the weight that its class and id add to
    its words, and whether they leave no doubt."""
    if name in SKIPPED:
        return True, 0.0, False
    if not attributes or name in ("html", "body", "article", "main"):
        return False, 0.0, False
    added, sure = 0.0, False
    for m in _ATTRIBUTE.finditer(attributes):
        key = m[1].lower()
        value = (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True, 0.0, False
        if key == "role":
            if value.strip() in ROLES:
                return True, 0.0, False
        elif key in ("class", "id"):
            weight, no_doubt = _named(m[2] or m[3] or m[4] or "")
            added, sure = min(added, weight), sure or no_doubt
    return False, added, sure


def _named(value: str) -> tuple[float, bool]:
    """``NAMED`` times the share of words that name a part that isn't article, among those
    that say anything; and whether half of these, or more, leave no doubt."""
    spaced = re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()
    named = said = certain = 0
    for token in spaced.split():
        parts = _PARTS.findall(token)
        for before, part in zip(["", *parts], parts, strict=False):
            hit = part in NOT_ARTICLE and before not in DENIES
            named += hit
            certain += hit and part in SURE
            said += hit or part not in NEUTRAL and part not in DENIES
    return (NAMED * named / said, 2 * certain >= said) if named else (0.0, False)


class _Open:
    """The elements that are open: a stack, with the places of each name and of containers,
    so that the innermost one of a kind is found at once however deep they are."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, bool, int, str]] = []  # name, skipped, marked, span or -1, innermost block
        self.places: dict[str, list[int]] = {}
        self.containers: list[int] = []

    def top(self) -> tuple[bool, bool, str]:
        return (self.stack[-1][1], self.stack[-1][2], self.stack[-1][4]) if self.stack else (False, False, "")

    def push(self, name: str, skipped: bool, marked: bool, span: int) -> None:
        block = name if name not in INLINE else self.top()[2]
        self.places.setdefault(name, []).append(len(self.stack))
        if name in CONTAINERS:
            self.containers.append(len(self.stack))
        self.stack.append((name, skipped, marked, span, block))

    def innermost(self, name: str) -> int:
        return (self.places.get(name) or [-1])[-1]

    def close(self, at: int) -> list[int]:
        """Close all elements from a place on; returns their spans."""
        spans = []
        while len(self.stack) > at:
            name, _, _, span, _ = self.stack.pop()
            self.places[name].pop()
            if self.containers and self.containers[-1] == len(self.stack):
                self.containers.pop()
            spans.append(span)
        return spans


def parse(page: str):
    """Tokens in page order: (kind, value, element, skipped, marked, added) with kind 'w'
    for a run of text and 't' for a tag; ``marked``: inside an article or main element;
    ``added``: what the names of its elements add to a word's weight."""
    opened = _Open()
    spans: list[list] = []  # named and outermost marked elements: first token, end, added weight, no doubt
    at, size = 0, len(page)
    out = []

    def close(i):
        for k in opened.close(i):
            if k >= 0:
                spans[k][1] = len(out)

    def text(a, b):
        if b > a:
            raw = page[a:b]
            skipped, marked, block = opened.top()
            out.append(("w", html.unescape(raw) if "&" in raw else raw, block, skipped, marked))

    while at < size:
        start = page.find("<", at)
        if start < 0:
            text(at, size)
            break
        m = _TOKEN.match(page, start)
        if not m:  # a bare '<' is text
            text(at, start + 1)
            at = start + 1
            continue
        text(at, start)
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if closing:
            depth = opened.innermost(name)
            skipped, marked, _ = opened.top()
            out.append(("t", name, "", skipped, marked))
            if depth >= 0:
                close(depth)
            continue
        container = opened.containers[-1] if opened.containers else -1
        if name in ENDS_PARAGRAPH and opened.innermost("p") > container:
            close(opened.innermost("p"))
        elif name == "li" and opened.innermost("li") >= max(container, 0):
            close(opened.innermost("li"))
        skipped, marked, _ = opened.top()
        left_out, added, sure = _left_out(name, attributes)
        skipped = skipped or left_out
        first, marked = not marked and name in ("article", "main"), marked or name in ("article", "main")
        out.append(("t", name, "", skipped, marked))
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
        elif name not in VOID and not attributes.rstrip().endswith("/"):
            spanned = not skipped and (added or first)
            if spanned:
                spans.append([len(out) - 1, 0, added, sure])
            opened.push(name, skipped, marked, len(spans) - 1 if spanned else -1)
    close(0)
    return _weigh_names(out, spans)


def _weigh_names(tokens: list, spans: list[list]) -> list:
    """Leave out named elements; add to the words of those that stay.

    A name without doubt is left out at any size.  Another is left out if its words, with
    what its name adds, weigh less than nothing, and it doesn't hold most words of the
    page.  An element that holds the page's article, the largest marked element that is in
    no element of a sure name, if there is one, counts as without a name; but of several
    marked elements in one of a sure name, as comments are, none is the article."""
    words, tags = [0], [0.0]
    for kind, value, _, skipped, _ in tokens:
        words.append(words[-1] + (0 if skipped or kind == "t" else len(value.split())))
        tags.append(tags[-1] + (0.0 if skipped or kind == "w" or value in INLINE else TAG))
    inside = [0] * (len(tokens) + 1)  # elements of a sure name that are open
    for a, b, _, sure in spans:
        if sure:
            inside[a] += 1
            inside[b] -= 1
    inside = list(accumulate(inside))
    marks = sorted((a, b) for a, b, added, _ in spans if not added)
    starts = [a for a, _ in marks]
    a, b = max(marks, key=lambda m: (not inside[m[0]], words[m[1]] - words[m[0]], -m[0]), default=(0, 0))
    article = (a, b) if words[b] > words[a] else None
    cut, more = [0] * (len(tokens) + 1), [0.0] * (len(tokens) + 1)
    for a, b, added, sure in spans:
        if not added:
            continue
        n = words[b] - words[a]
        if article and a <= article[0] and article[1] <= b and not (sure and bisect_left(starts, b) - bisect_left(starts, a) > 1 and inside[article[0]]):
            continue
        if sure or 2 * n <= words[-1] and (WORD + added) * n + tags[b] - tags[a] < 0:
            cut[a] += 1
            cut[b] -= 1
        elif 2 * n <= words[-1]:
            more[a] += added
            more[b] -= added
    out, left, added = [], 0, 0.0
    for (kind, value, element, skipped, mark), c, x in zip(tokens, cut, more, strict=False):
        left, added = left + c, added + x
        out.append((kind, value, element, skipped or left > 0, mark, added))
    return out


def scores(tokens: list, weights: Weights) -> list[float]:
    """The weight of each token.  What is left out anyway costs nothing but its tags, so
    an advert amid the article doesn't end the region.  If the page marks its article, at
    whatever share of its text, words elsewhere are negative."""
    words = [len(value.split()) if kind == "w" else 0 for kind, value, *_ in tokens]
    marks = any(n and t[4] and not t[3] for n, t in zip(words, tokens, strict=True))
    out = []
    for n, (kind, value, element, skipped, marked, added) in zip(words, tokens, strict=True):
        if kind == "t":
            out.append(_INLINE_COST if skipped or marks and marked else weights.tag(value))
        elif marks and not marked:
            out.append(LEFT_OUT * n)
        else:
            out.append(0.0 if skipped else (weights.word(element) + added) * n)
    return out


def extract(page: str | None, weights: Weights) -> str:
    """The article text of one page."""
    if not page:
        return ""
    tokens = parse(page)
    best, best_span, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores(tokens, weights)):
        total += score
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_span = total, (start, i + 1)
    blocks: list[str] = []
    block: list[str] = []
    for kind, value, _, skipped, *_ in tokens[slice(*best_span)]:
        if kind == "w":
            if not skipped:
                block.append(value)
        elif value == "br":
            block.append(" ")
        elif value not in INLINE:
            blocks.append(" ".join("".join(block).split()))
            block = []
    blocks.append(" ".join("".join(block).split()))
    return "\n".join(b for b in blocks if b)


def learn(pages: list[str]) -> Weights:
    """Weights from pages that mark their article."""
    inside: Counter = Counter()
    outside: Counter = Counter()
    for page in pages:
        for kind, value, element, skipped, marked, _ in parse(page):
            if not skipped:
                (inside if marked else outside)[(kind, element if kind == "w" else value)] += len(value.split()) if kind == "w" else 1
    n_in, n_out = sum(inside.values()) + 1, sum(outside.values()) + 1
    out = Weights()
    for key in {*inside, *outside}:
        odds = math.log((inside[key] + 0.5) / n_in) - math.log((outside[key] + 0.5) / n_out)
        kind, name = key
        if kind == "w":
            out.words[name] = min(2.0, max(0.5, WORD + odds / 4))
        elif name not in INLINE:
            out.tags[name] = max(-2.0, min(-0.1, TAG + odds / 8))
    return out


def fit(pages: DataFrame, text: str = "html", page_id: str = "page_id") -> Weights:
    marked = F.col(text).rlike("(?i)<(article|main)[\\s>]") & (F.length(text) <= MAX_CHARS)
    draw = F.pmod(F.xxhash64(F.col(page_id), F.lit(9)), F.lit(1 << 30)) / float(1 << 30)
    usable = pages.where(marked)
    drawn = usable.where(draw < 1.5 * MAX_PAGES / max(1, usable.count()))
    got = drawn.select(F.col(text).alias("t"), F.xxhash64(page_id, F.lit(9)).alias("h")).orderBy("h", "t").limit(MAX_PAGES).collect()
    return learn([r["t"] for r in got])


def main_text(pages: DataFrame, weights: Weights, text: str = "html", into: str = "text") -> DataFrame:
    """All columns of ``pages`` plus the article text."""
    return add_from_text(pages, [(into, "string", pa.string())], lambda: lambda htmls: [[extract(h, weights) for h in htmls]], text)


def report(pages: DataFrame) -> DataFrame:
    """The query's result: the article text of every page and its length."""
    pages = pages.select("page_id", "url", "html")
    out = main_text(pages, fit(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
