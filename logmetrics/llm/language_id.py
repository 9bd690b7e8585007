"""Language identification by prediction by partial matching.

For each language a variable-order context tree over bytes is counted on labelled texts
and then frozen.  In a context, a symbol seen there has probability c / (n + d), for c of
n occurrences with d distinct symbols; the escape d / (n + d) is shared out over the
others as the next shorter context has them, so each context's distribution sums to one,
down to the uniform one over all bytes.  A text's exact code length under each language
decides; the score is the posterior of the shortest code under equal priors.

The trees of all languages share their nodes, so one walk finds the longest context for
all of them: since no context is longer than ``ORDER`` bytes, walking the last ``ORDER``
bytes from the root does, for all positions at once.

Bounds.  Every language is learned, on about ``CHARS_PER_LANGUAGE`` characters of texts
drawn by a hash of the id; of a longer text, its first ``MAX_TRAIN_CHARS`` characters are
learned.  Languages go in groups of ``GROUP``, each with its own trees and a frozen table
of ``MAX_CELLS`` cells, so further languages don't make the trees of others shallower, and
the driver holds one group's texts at a time.  Prediction is one narrow scan of whole
texts, without a shuffle.

Cases.  Null texts and those without a letter are ``und`` with score 0; without any
labelled row all are.  Null languages are not learned.  Ties go to the language that
sorts first.  Repeated rows and ids are scored row by row."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_from_text, fold

ORDER = 5
CHARS_PER_LANGUAGE = 2_000_000
MAX_TRAIN_CHARS = 20_000
#: Least occurrences of a context that becomes a node.
MIN_COUNT = 4
#: Nodes x symbols x languages of the frozen table (float32).
MAX_CELLS = 4_000_000
#: Languages whose trees share nodes.
GROUP = 24
_CHUNK = 1 << 20
UNDETERMINED = "und"


@dataclass
class Model:
    languages: list[str]
    symbol_of: np.ndarray  # byte -> symbol; 0 is the text's edge
    step: np.ndarray  # (node, symbol) -> node
    bits: np.ndarray  # (node, symbol, language) -> code length

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """(text, language) -> bits of the whole text."""
        out = np.zeros((len(texts), len(self.languages)))
        edge = bytes(ORDER)
        n_sym = self.step.shape[1]
        flat_step, flat_bits = self.step.ravel(), self.bits.reshape(-1, len(self.languages))
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        # Symbols with ORDER edges before each text; an empty text stays one edge run.
        raw = np.frombuffer(edge + edge.join(t for t in texts), dtype=np.uint8)
        x = self.symbol_of.astype(np.uint8)[raw]
        starts = np.cumsum(np.concatenate([[ORDER], sizes[:-1] + ORDER]))
        for a, n in zip(starts.tolist(), sizes.tolist(), strict=True):
            x[a - ORDER : a] = 0
        bounds = np.append(starts - ORDER, len(x))  # a text's edges and bytes
        for a in range(ORDER, len(x), _CHUNK):
            b = min(len(x), a + _CHUNK)
            node = np.zeros(b - a, dtype=np.int64)
            for k in range(ORDER, 0, -1):
                node = flat_step[node * n_sym + x[a - k : b - k]].astype(np.int64)
            now = x[a:b]
            real = now != 0
            cost = flat_bits[(node * n_sym + now)[real]]
            first, last = np.searchsorted(bounds, [a, b - 1], side="right") - 1
            cut = np.clip(bounds[first : last + 2], a, b)
            who = np.repeat(np.arange(first, last + 1), np.diff(cut))[real]
            if len(who):
                cuts = np.flatnonzero(np.diff(who)) + 1
                at = np.concatenate([[0], cuts])
                out[who[at]] += np.add.reduceat(cost, at, axis=0, dtype=np.float64)
        return out


def learn(texts: list[bytes], languages: list[str]) -> Model:
    """Count and freeze the trees; null bytes of a text count as an unknown byte."""
    names = sorted(set(languages))
    seen = Counter()
    for t in texts:
        seen.update(t)
    common = [b for b, _ in seen.most_common(159) if b]
    symbol_of = np.full(256, 1, dtype=np.int64)  # 1: any rare byte
    for k, b in enumerate(sorted(common)):
        symbol_of[b] = k + 2
    n_sym, n_rare = len(common) + 2, 256 - len(common)
    edge = np.zeros(ORDER, dtype=np.int64)
    counts: list[list[tuple[np.ndarray, np.ndarray]]] = []  # language -> order -> keys, counts
    for name in names:
        parts = []
        for t, lang in zip(texts, languages, strict=True):
            if lang == name:
                parts += [edge, symbol_of[np.frombuffer(t, dtype=np.uint8)]]
        x = np.concatenate(parts)
        per_order = []
        for k in range(ORDER + 1):  # key: k context symbols, then the symbol coded
            key = np.zeros(len(x) - ORDER, dtype=np.int64)
            for j in range(k, -1, -1):
                key = key * n_sym + x[ORDER - j : len(x) - j]
            per_order.append(np.unique(key[x[ORDER:] != 0], return_counts=True))
        counts.append(per_order)
    # Nodes: the most frequent contexts of any language, shorter ones first.  A context's
    # tail and head are at least as frequent as itself, so both are nodes, too.
    most = max(256, MAX_CELLS // (n_sym * len(names)))
    ranked = []
    for k in range(1, ORDER + 1):
        total: Counter = Counter()
        for per_order in counts:
            keys, c = per_order[k]
            ctx, first = np.unique(keys // n_sym, return_index=True)
            for key, n in zip(ctx.tolist(), np.add.reduceat(c, first).tolist() if len(c) else [], strict=False):
                total[key] = max(total[key], n)
        ranked += [(-n, k, key) for key, n in total.items() if n >= MIN_COUNT]
    ranked = sorted(ranked)[: most - 1]
    node_of = {(0, 0): 0}
    for _, k, key in sorted(ranked, key=lambda r: (r[1], r[2])):
        if (k - 1, key % n_sym ** (k - 1)) in node_of and (k - 1, key // n_sym) in node_of:
            node_of[k, key] = len(node_of)
    step = np.zeros((len(node_of), n_sym), dtype=np.int32)
    p = np.zeros((len(node_of), n_sym, len(names)), dtype=np.float64)
    base = np.full(n_sym, 1 / 256)
    base[0], base[1] = 0, n_rare / 256
    for (k, key), node in node_of.items():
        shorter = node_of[k - 1, key % n_sym ** (k - 1)] if k else None
        step[node] = step[shorter] if k else 0
        for s in range(n_sym):
            longer = node_of.get((k + 1, key * n_sym + s))
            if longer is not None:
                step[node, s] = longer
        for j, per_order in enumerate(counts):
            prior = p[shorter, :, j] if k else base
            keys, c = per_order[k]
            a, b = np.searchsorted(keys, [key * n_sym, (key + 1) * n_sym])
            if a == b:
                p[node, :, j] = prior
                continue
            sym, n = keys[a:b] % n_sym, c[a:b]
            row = prior.copy()
            row[sym] = 0
            left, d = row.sum(), len(sym)
            escape = d / (n.sum() + d) if left > 0 else 0.0
            row *= escape / left if left > 0 else 0.0
            row[sym] = n / n.sum() * (1 - escape)
            p[node, :, j] = row
    p[:, 1, :] /= n_rare  # a rare byte is one of n_rare
    with np.errstate(divide="ignore"):
        bits = -np.log2(p)
    bits[:, 0, :] = 0
    return Model(names, symbol_of, step, np.minimum(bits, 64).astype(np.float32))


@dataclass
class Grouped:
    """Models of groups of languages, as one."""

    models: list[Model]

    @property
    def languages(self) -> list[str]:
        return [name for m in self.models for name in m.languages]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        return np.concatenate([m.code_lengths(texts) for m in self.models], axis=1)


def fit(docs: DataFrame, train, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Grouped | None:
    """Learn from the rows of ``docs`` with a language for which the condition ``train``
    holds: a draw by a hash of the id, whose rate per language comes from a count."""
    part = F.substring(text, 1, MAX_TRAIN_CHARS)
    rows = docs.where(train & F.col(lang).isNotNull() & (F.length(text) > 0)).select(part.alias("t"), F.col(lang).alias("lang"), F.xxhash64(doc_id, F.lit(11)).alias("h"))
    size = {r[0]: r[1] for r in rows.groupBy("lang").agg(F.sum(F.length("t"))).collect()}
    draw = F.pmod(F.col("h"), F.lit(1 << 30)) / float(1 << 30)
    names, models = sorted(size), []
    for at in range(0, len(names), GROUP):
        rate = F.lit(0.0)
        for name in names[at : at + GROUP]:  # half more than wanted, for chance
            share = 1.5 * max(CHARS_PER_LANGUAGE, 20 * MAX_TRAIN_CHARS) / size[name]
            rate = F.when(F.col("lang") == name, 2.0 if share >= 1 else share).otherwise(rate)
        got = rows.where(draw < rate).select(F.col("t").cast("binary"), "lang", "h").collect()
        taken: Counter = Counter()
        texts, languages = [], []
        for t, name, _ in sorted(got, key=lambda r: (r[2], bytes(r[0]))):
            if taken[name] < CHARS_PER_LANGUAGE:
                taken[name] += len(t)
                texts.append(bytes(t))
                languages.append(name)
        if texts:
            models.append(learn(texts, languages))
    return Grouped(models) if models else None


def predict(docs: DataFrame, model: Model | Grouped | None, text: str = "text", into: tuple[str, str, str] = ("lang_pred", "score", "bits_per_byte")) -> DataFrame:
    """All columns of ``docs`` plus the language, its posterior and its code length."""

    names = model.languages if model else []

    def make():
        def work(texts):
            known = [t.decode("utf-8", "replace") if t else "" for t in texts]
            has = [model is not None and any(map(str.isalpha, t)) for t in known]
            lang, score, rate = [UNDETERMINED] * len(texts), [0.0] * len(texts), [None] * len(texts)
            at = [i for i, ok in enumerate(has) if ok]
            if at:
                bits = model.code_lengths([texts[i] for i in at])
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(at)), best]
                post = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                for i, k, s, b in zip(at, best.tolist(), post.tolist(), least.tolist(), strict=True):
                    lang[i], score[i], rate[i] = names[k], s, b / len(texts[i])
            return [lang, score, rate]

        return work

    fields = [(into[0], "string", pa.string()), (into[1], "double", pa.float64()), (into[2], "double", pa.float64())]
    return add_from_text(docs, fields, make, text, as_bytes=True)


def report(docs: DataFrame) -> DataFrame:
    """The query's result: language and score of every document."""
    held_out = fold(F.col("doc_id"), 5) == 0
    model = fit(docs.select("doc_id", "text", "lang"), ~held_out)
    scored = predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")
