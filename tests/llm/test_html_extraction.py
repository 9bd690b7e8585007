import re
import time
from html.parser import HTMLParser

import pytest
from llm.helpers import LONG

from logmetrics.llm import html_extraction as h

SCHEMA = "page_id bigint, url string, html string, text string, n_chars int"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav><!-- ad 1 -->
<div class="ad">Buy this fine thing now</div><div id="cookie-notice">We use cookies here</div>
<article><h1>Title &amp; more</h1><p>First   paragraph of <b>bold</b>ly set&nbsp;words.<p>Second one, unclosed
<aside>Related: other things</aside><form><input><label>Your mail</label></form>
<ul><li>point one</li><li>point two</li></ul>{extra}</article>
<section class="comments"><p>A reader says many words about this and that</p></section>
<footer>&copy; somebody and a long line of legal words</footer></body></html>"""
TEXT = "Title & more\nFirst paragraph of boldly set words.\nSecond one, unclosed\npoint one\npoint two"


def test_article_only():
    assert h.extract(PAGE.format(extra=""), h.Weights()) == TEXT
    learned = h.learn([PAGE.format(extra="")] * 5)
    assert h.extract(PAGE.format(extra=""), learned) == TEXT
    assert all(w > 0 for w in learned.words.values()) and all(w < 0 for w in learned.tags.values())


def test_best_region_equals_all_regions():
    """The linear scan finds the sum that trying all pairs of ends finds."""
    w = h.Weights()
    for page in (PAGE.format(extra="<p>x</p>"), "<div>a b</div>" + "<br/><hr>" * 20 + "<p>c d e f</p>", "<p>a</p><table><tr><td>b"):
        scores = h.scores(h.parse(page), w)
        best = max((sum(scores[a:b]), -a, b) for a in range(len(scores)) for b in range(a, len(scores) + 1))
        total, top, span, start = 0.0, 0.0, (0, 0), 0
        for i, x in enumerate(scores):
            total += x
            if total <= 0:
                total, start = 0.0, i + 1
            elif total > top:
                top, span = total, (start, i + 1)
        assert abs(best[0] - top) < 1e-9
        assert abs(sum(scores[slice(*span)]) - top) < 1e-9


def test_unmarked_page():
    page = PAGE.format(extra="<p>" + "and a longer closing paragraph " * 9 + "</p>").replace("article", "div")
    assert h.extract(page, h.Weights()).startswith(TEXT) and "reader" not in h.extract(page, h.Weights())


def test_names_are_weighed():
    """A class or id that only mentions a menu, a sidebar or comments cuts no article."""
    w = h.Weights()
    text = "A first sentence with a number of words in it and then some more of them."
    for name in ("layout has-sidebar", "post no-comments", "sidebar", "hasSidebar", "share", "comments"):
        for inner in ("div", "article", "main"):
            if inner == "div" and name in ("sidebar", "comments"):  # nothing says that this is the article
                continue
            page = f'<div id="menu"><p>Home About</p></div><div class="{name}"><{inner}><p>{text}</p><p>{text}</p></{inner}></div>'
            assert h.extract(page, w) == f"{text}\n{text}", (name, inner)
    parts = "".join(f'<section {name}><p>{text}</p></section>' for name in ('id="related-work"', 'class="search-results"', 'class="intro"'))
    assert h.extract(f"<div>{parts}</div>", w) == "\n".join([text] * 3)
    small = "".join(f'<div class="{name}"><p>Few words</p></div><p>{text}</p>' for name in ("ad-slot", "comment-list", "share-buttons", "site-footer", "sidebar-left", "related-posts"))
    assert h.extract(f"<body><p>{text}</p>{small}</body>", w) == "\n".join([text] * 7)
    deep = '<div class="ad">' * 100 + "deep words" + "</div>" * 100
    assert h.extract(f"<p>{text}</p>{deep}<p>{text}</p>", w) == f"{text}\n{text}"


WORDS = " ".join(f"word{i}" for i in range(40))
LONGER = " ".join(f"other{i}" for i in range(400))


@pytest.mark.parametrize("name", ['class="comments"', 'id="cookie-consent"', 'class="sidebar"', 'id="post-comments"', 'class="ad-slot top"', 'class="main-menu"'])
@pytest.mark.parametrize("element", ["article", "div"])
def test_long_named_parts_are_never_text(name, element):
    w = h.Weights()
    for part in (f"<div {name}><p>{LONGER}</p></div>", f"<div {name}>" + f"<article><p>{LONGER}</p></article>" * 3 + "</div>"):
        for page in (f"<{element}><p>{WORDS}</p></{element}>{part}", f"{part}<{element}><p>{WORDS}</p></{element}>", f"<{element}><p>{WORDS}</p>{part}</{element}>"):
            assert h.extract(f"<body>{page}</body>", w) == WORDS


def test_a_marked_article_counts_at_any_share():
    w = h.Weights()
    assert h.extract(f"<p>{LONGER}</p><article><p>{WORDS}</p></article><p>{LONGER}</p>", w) == WORDS
    assert h.extract(f'<div class="sidebar"><article><p>{WORDS}</p></article></div><p>{LONGER}</p>', w) == WORDS


class Reference(HTMLParser):
    """Another parser: text in article elements, outside of what is never article."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.stack, self.blocks = [], [""]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        names = " ".join(v or "" for k, v in attrs if k in ("class", "id"))
        if tag == "br":
            self.blocks[-1] += " "
        elif tag not in h.INLINE:
            self.blocks.append("")
        if tag == "p":  # a paragraph ends the one before
            while any(t == "p" for t, _ in self.stack) and self.stack[-1][0] in ("p", "b"):
                self.stack.pop()
        if tag not in h.VOID:
            self.stack.append((tag, tag in h.SKIPPED or bool(re.search(r"\b(ads?|cookie|comments|sidebar|notice)\b", names))))

    def handle_endtag(self, tag):
        if tag not in h.INLINE:
            self.blocks.append("")
        if any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if any(t in ("article", "main") for t, _ in self.stack) and not any(skip for _, skip in self.stack):
            self.blocks[-1] += data

    def text(self):
        return "\n".join(b for b in (" ".join(x.split()) for x in self.blocks) if b)


def test_test_pages_equal_another_parser(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    marked = [r for r in rows if r.html and "<article" in r.html]
    got = {r.page_id: r.text for r in h.report(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()}
    assert len(marked) > 100
    assert [r.page_id for r in marked if got[r.page_id] != Reference(r.html).text()] == []


def test_deep_pages_take_linear_time():
    w = h.Weights()
    start = time.perf_counter()
    assert h.extract("<b>x " * 250_000, w).count("x") == 250_000
    assert h.extract("<div>" * 100_000 + "deep words" + "</div>" * 100_000, w) in ("deep words", "")
    assert h.extract("<p>" + "<i>a</b>" * 100_000, w).count("a") == 100_000
    assert h.extract("<ul>" + "<li><b>word " * 100_000, w).count("word") == 100_000
    h.extract('<div class="ad">word' * 50_000, w)
    assert time.perf_counter() - start < 60


def test_odd_pages():
    w = h.Weights()
    assert h.extract(None, w) == h.extract("", w) == h.extract("<p></p><!-- open", w) == ""
    assert h.extract("plain words", w) == "plain words"
    assert h.extract("<p>1 < 2 and 3 <b", w) == "1 < 2 and 3"
    assert h.extract("<p>a&amp", w) == "a&"
    assert h.extract("<p>cut &quo", w) == "cut &quo"
    assert h.extract("<script>never ends", w) == ""
    assert h.extract("<p>a<br>b</p></div></div><p title='x>y'>c d", w) == "a b\nc d"
    assert h.extract("<article><p>" + "word " * 50_000 + "</p></article>", w).count("word") == 50_000
    assert len(h.extract("<div>" * 3000 + "deep words here" + "</div>" * 3000, w)) > 0


def test_all_marked_pages_are_used(spark, monkeypatch):
    """Up to the bound, however few of the pages are marked."""
    used = []
    monkeypatch.setattr(h, "learn", lambda pages: used.append(len(pages)))
    rows = [(i, "u", PAGE.format(extra="") if i % 100 == 0 else "<p>no mark</p>", "c", 1) for i in range(4000)]
    pages = spark.createDataFrame(rows, SCHEMA)
    h.fit(pages)
    monkeypatch.setattr(h, "MAX_PAGES", 10)
    h.fit(pages)
    assert used[0] == 40 and 0 < used[1] <= 10


def test_report(spark):
    rows = [(i, f"http://x/{i}", PAGE.format(extra=""), "clash", 1) for i in range(5)]
    rows += [(7, "u", None, "c", 1), (8, None, "", "c", 1), (None, "u", "<p>words of a page</p>", "c", 1), (9, "u", f"<article><p>{LONG}</p></article>", "c", 1), (9, "u", "<p>twice</p>", "c", 1), (9, "u", "<p>twice</p>", "c", 1)]
    pages = spark.createDataFrame(rows, SCHEMA)
    out = h.report(pages).collect()
    assert len(out) == len(rows)
    assert [r.text for r in out if r.page_id is not None and r.page_id < 5] == [TEXT] * 5
    assert {(r.text, r.n_chars) for r in out if r.page_id in (7, 8)} == {("", 0)}
    assert max(r.n_chars for r in out) == len(LONG)
    assert "text_" in h.main_text(pages, h.Weights()).columns
    assert h.report(spark.createDataFrame([], SCHEMA)).count() == 0
