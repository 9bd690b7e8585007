"""Toxicity: a weighted lexicon of word beginnings, matched by one Aho-Corasick pass over
folded text, normalised by length, with exception phrases.

Folding maps case, accents, look-alike letters of other scripts and digits used as
letters to plain a-z; every other character is a word break.  The lexicon is learned from
labelled texts: beginnings of words (a whole word is its longest beginning) whose share
of toxic texts exceeds that of the others, weighted by the smoothed log-odds.  A phrase
of a lexicon word and its neighbour that only untoxic texts use becomes an exception: its
weight is taken back wherever it occurs.  Two features of the weighted sum, the sum and
the sum per word, enter a logistic fit that gives the score.

Bounds.  Learning uses at most ``MAX_TOXIC`` and ``MAX_OTHER`` labelled texts of at most
``MAX_CHARS`` characters, drawn by a hash of the id; class sizes come from all labelled
rows.  The model (a few thousand short strings at most) is what each task gets.  Scoring
is one narrow scan over whole texts: no shuffle, whatever the skew.

Cases.  Null and empty texts have no matches and get the score of a text without any.
Labels that are null, or for ids with several labels, count row by row; null labels are
skipped.  With no labelled rows, or of one class only, the lexicon is empty and every
score is the share of toxic labels (0 without labels)."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from dataclasses import dataclass, field
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_from_text, fold, fresh

MAX_TOXIC = 4_000
MAX_OTHER = 6_000
MAX_CHARS = 60_000
MAX_ENTRIES = 2_000
SHORTEST, LONGEST = 4, 16
#: Expected number of lexicon entries that only chance made.
MAX_CHANCE = 0.05
THRESHOLD = 0.3

# Characters read as Latin letters.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
CYRILLIC = dict(zip("авсдеёкіјмнорѕтухцъь", "abcdeekijmhopstyxubb", strict=True))
GREEK = dict(zip("αβγδεζηικμνορστυχω", "abydeznikuvopotuxw", strict=True))


class _Folding(dict):
    """Code point to folded letters, worked out on first sight."""

    def __missing__(self, code: int):
        c = chr(code).lower()
        base = unicodedata.normalize("NFKD", c)
        out = "".join(
            y
            for x in base
            if not unicodedata.combining(x)
            for y in [DIGITS.get(x) or CYRILLIC.get(x) or GREEK.get(x) or (x if x.isalpha() else " ")]
        )
        if unicodedata.category(chr(code)) in ("Mn", "Cf"):  # accents and invisible characters
            out = ""
        self[code] = out or ("" if unicodedata.category(chr(code)) in ("Mn", "Cf") else " ")
        return self[code]


_FOLDING = _Folding()


def fold_text(text: str | None) -> str:
    """Folded text with a space at both ends."""
    return f" {text.translate(_FOLDING)} " if text else "  "


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)  # " beginning" -> weight
    exceptions: dict[str, float] = field(default_factory=dict)  # " phrase " -> weight taken back
    coefficients: tuple[float, float, float] = (0.0, 0.0, 0.0)  # intercept, sum, sum per word

    def automaton(self):
        a = ahocorasick.Automaton()
        for s, w in {**self.weights, **{s: -w for s, w in self.exceptions.items()}}.items():
            a.add_word(s, w)
        if len(a):
            a.make_automaton()
        return a


def _features(automaton, folded: str) -> tuple[float, float]:
    total = sum(w for _, w in automaton.iter(folded)) if len(automaton) else 0.0
    n = len(folded.split())
    total = max(0.0, total)
    return math.log1p(total), math.log1p(100.0 * total / max(n, 1))


def _unlike(texts: list[str]) -> list[int]:
    """Indices of texts of which no nearly equal one came before: any of 16 minima of
    hashed 3-word runs that was seen already marks a copy."""
    seen: set = set()
    factors = np.random.default_rng(7).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    kept = []
    for i, t in enumerate(texts):
        w = t.split()
        runs = [" ".join(x) for x in zip(w, w[1:], w[2:], strict=False)] or [t]
        hashes = np.array([crc32(x.encode()) for x in runs], dtype=np.uint64)
        keys = set(enumerate((hashes[:, None] * factors >> np.uint64(20)).min(axis=0).tolist()))
        if not keys & seen:
            kept.append(i)
        seen |= keys
    return kept


def _beginnings(folded: str) -> set[str]:
    return {w[:n] for w in set(folded.split()) for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}


def learn(texts: list[str], toxic: list[int], share: float) -> Model:
    """Fit on unfolded texts; ``share``: that of toxic rows among all labelled ones."""
    prior = min(max(share, 1e-4), 1 - 1e-4)
    flat = Model(coefficients=(math.log(prior / (1 - prior)), 0.0, 0.0))
    folded = [fold_text(t) for t in texts]
    keep = _unlike(folded)
    folded, y = [folded[i] for i in keep], np.array([toxic[i] for i in keep], dtype=float)
    n_pos, n_neg = int(y.sum()), int(len(y) - y.sum())
    if not n_pos or not n_neg:
        return flat
    pos: Counter = Counter()
    neg: Counter = Counter()
    for t in (t for t, k in zip(folded, y, strict=True) if k):
        pos.update(_beginnings(t))
    tried, least = len(pos), max(3, n_pos // 100)
    pos = Counter({s: p for s, p in pos.items() if p >= least})
    for t in (t for t, k in zip(folded, y, strict=True) if not k):
        neg.update(_beginnings(t) & pos.keys())
    found = {}
    for s, p in pos.items():
        n = neg.get(s, 0)
        w = math.log((p + 0.5) / (n_pos + 1)) - math.log((n + 0.5) / (n_neg + 1))
        if w > math.log(8) and _chance(p, p + n, n_pos / (n_pos + n_neg)) < MAX_CHANCE / tried:
            found[s] = (w, p)
    longer = Counter()
    for s, (_, p) in found.items():
        longer[s[:-1]] = max(longer[s[:-1]], p)
    weights: dict[str, float] = {}
    for s in sorted(found, key=lambda s: (len(s), s)):
        w, p = found[s]
        if longer[s] >= 0.9 * p:  # a longer beginning says as much, more safely
            continue
        if any(" " + s[:n] in weights for n in range(SHORTEST, len(s))):
            continue
        weights[" " + s] = w
    weights = dict(sorted(weights.items(), key=lambda x: (-x[1], x[0]))[:MAX_ENTRIES])
    model = Model(weights=weights)
    model.exceptions = _exceptions(folded, y, weights)
    a = model.automaton()
    x = np.array([[1.0, *_features(a, t)] for t in folded])
    weight = np.where(y == 1, prior / n_pos, (1 - prior) / n_neg) * len(y)
    b = np.zeros(3)
    for _ in range(50):  # ridge-penalised Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        ridge = np.diag([1e-6, 0.02, 0.02])
        grad = x.T @ (weight * (y - p)) - ridge @ b
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, grad)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    b[1:] = np.maximum(b[1:], 0)
    model.coefficients = tuple(float(v) for v in b)
    return model


def _chance(p: int, n: int, share: float) -> float:
    """Bound on the chance that ``p`` or more of ``n`` texts are toxic if a text is with
    probability ``share`` (Chernoff)."""
    q = p / n
    if q <= share:
        return 1.0
    rest = (1 - q) * math.log((1 - q) / (1 - share)) if q < 1 else 0.0
    return math.exp(-n * (q * math.log(q / share) + rest))


def _exceptions(folded: list[str], y: np.ndarray, weights: dict[str, float]) -> dict[str, float]:
    """Two-word phrases around a lexicon word that untoxic texts use and toxic ones don't."""
    pos: Counter = Counter()
    neg: Counter = Counter()
    weight_of: dict[str, float] = {}
    for t, k in zip(folded, y, strict=True):
        words = t.split()
        phrases = set()
        for i, word in enumerate(words):
            w = max((weights.get(" " + word[:n], 0.0) for n in range(SHORTEST, min(LONGEST, len(word)) + 1)), default=0.0)
            if w:
                near = [" ".join(words[a : a + 2]) for a in (i - 1, i) if 0 <= a < len(words) - 1]
                phrases.update(f" {x} " for x in near)
                weight_of.update((f" {x} ", w) for x in near)
        (pos if k else neg).update(phrases)
    return {s: weight_of[s] for s, n in neg.items() if n >= 3 and not pos.get(s)}


def fit(docs: DataFrame, labels: DataFrame, train=None, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Model:
    """Learn from labelled rows; ``train`` maps the id column to a condition on the rows
    to learn from (all by default).  The draw is made on ids, before texts are read."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("id").isNotNull())
    if train is not None:
        known = known.where(train(F.col("id")))
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if not n:
        return Model(coefficients=(math.log(1e-4), 0.0, 0.0))
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    texts, ys = [], []
    for k, most in ((1, MAX_TOXIC), (0, MAX_OTHER)):
        drawn = known.where((F.col("y") == k) & (draw < 1.2 * most / max(n.get(k, 0), 1))).select("id").distinct()
        rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(F.length("text") <= MAX_CHARS)
        rows = rows.join(F.broadcast(drawn), "id")  # about 1.2 * most ids
        got = rows.select("text", F.xxhash64("id", F.lit(7)).alias("h")).orderBy("h", "text").limit(most).collect()
        texts += [r["text"] for r in got]
        ys += [k] * len(got)
    return learn(texts, ys, n.get(1, 0) / sum(n.values()))


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` plus ``into``: probability that the text is toxic."""

    def make():
        automaton = model.automaton()
        b0, b1, b2 = model.coefficients

        def work(texts):
            out = []
            for t in texts:
                x1, x2 = _features(automaton, fold_text(t))
                out.append(1 / (1 + math.exp(-max(-40.0, min(40.0, b0 + b1 * x1 + b2 * x2)))))
            return [out]

        return work

    return add_from_text(docs, [(into, "double", pa.float64())], make, text)


def held_out(doc_id):
    return fold(doc_id, 4) == 2


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's result: score and decision of every document."""
    docs = docs.select("doc_id", "text")
    model = fit(docs, labels.select("doc_id", "toxic"), lambda i: ~held_out(i))
    scored = score(docs, model, into="score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score at or above the threshold."""
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), lambda i: ~held_out(i))
    into = fresh(docs, "toxicity")
    return score(docs, model, into=into).where(F.col(into) < threshold).drop(into)
