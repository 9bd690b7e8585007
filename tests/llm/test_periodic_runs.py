import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import EDGE, LONG, docs_of, empty_docs

from logmetrics.llm import periodic_runs as p


def plain_runs(words, least=6, periods=4):
    """Every period at every place: stretches of equal words one period apart, kept at
    their smallest period."""
    n, found = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= 2 * q:
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((a, b - a, q) for (a, b), q in found.items() if b - a >= max(least, periods * q))


def planted(key, words):
    h = zlib.crc32(str(key).encode()) if key is not None else 0
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    per = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % per] for i in range(n)]


def expected(key, text):
    words = planted(key, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = plain_runs(words)
    drop = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    return key, len(runs), *top, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in drop))


texts = st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=5)


@settings(max_examples=400, deadline=None)
@given(texts, st.sampled_from([(6, 4), (2, 2), (5, 3)]))
def test_runs_equal_brute_force(lists, limits):
    bounds = np.cumsum([0, *map(len, lists)])
    got = list(zip(*(x.tolist() for x in p.find_runs(np.array(sum(lists, []), dtype=np.int64), bounds, *limits)), strict=True))
    want = [(a + int(b), n, q) for b, words in zip(bounds, lists, strict=False) for a, n, q in plain_runs(words, *limits)]
    assert got == want


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 9), st.integers(0, 60), st.integers(0, 3))
def test_runs_of_repeated_blocks(period, times, tail):
    words = [7, *([*range(period)] * times), *range(tail), 8]
    got = list(zip(*(x.tolist() for x in p.find_runs(np.array(words), np.array([0, len(words)]))), strict=True))
    assert got == plain_runs(words)


def test_fibonacci_words_and_portions(monkeypatch):
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    monkeypatch.setattr(p, "AT_ONCE", 7)
    got = list(zip(*(x.tolist() for x in p.find_runs(np.array(b), np.array([0, len(b)]), 2, 2)), strict=True))
    assert got == plain_runs(b, 2, 2) and len(got) > 300


def test_long_texts_take_seconds():
    for words in (np.zeros(300_000, np.int64), np.arange(300_000) % 1000, np.random.default_rng(1).integers(0, 5, 300_000)):
        start, length, period = p.find_runs(words, np.array([0, len(words)]))
        assert (length >= np.maximum(6, 4 * period)).all()
    one = p.find_runs(np.zeros(300_000, np.int64), np.array([0, 300_000]))
    assert [x.tolist() for x in one] == [[0], [300_000], [1]]


def test_report_equals_brute_force(spark):
    rows = [(i, t) for i, t in EDGE if t != LONG]
    rows += [(100 + i, "spam " * (i % 23) + " ".join(f"w{j % (1 + i % 7)}" for j in range(3 * i % 61))) for i in range(90)]
    rows += [(1000 + i, " ".join(f"x{(j * j + i) % 97}" for j in range(40 + i))) for i in range(60)]
    got = sorted(map(tuple, p.report(docs_of(spark, rows)).collect()), key=str)
    assert got == sorted((expected(i, t) for i, t in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 40
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)


def test_operator_returns_runs_and_text(spark):
    docs = docs_of(spark, [(1, "a\tb a b  a b a b\nend"), (2, None), (3, "é é é é é é é ü")]).withColumnRenamed("key", "runs")
    out = {r.doc_id: r for r in p.periodic_runs(docs).collect()}
    assert [tuple(r) for r in out[1].runs_] == [(0, 8, 2)] and out[1].collapsed == "a b end"
    assert out[2].runs_ == [] and out[2].collapsed == ""
    assert [tuple(r) for r in out[3].runs_] == [(0, 7, 1)] and out[3].collapsed == "é ü"


def test_long_text_and_empty_table(spark):
    assert p.report(docs_of(spark, [(1, LONG)])).first().n_runs >= 0
    assert p.report(empty_docs(spark)).count() == 0


def test_test_tables_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 4000]
    want = {e[0]: e for e in (expected(i, t) for i, t in rows)}
    got = {r.doc_id: tuple(r) for r in p.report(docs).collect()}
    assert all(got[i] == e for i, e in want.items()) and len(want) > 100
