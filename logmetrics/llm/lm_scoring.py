"""Language-model scoring: a gated recurrent network with class-factored softmax.

Tokens are the lower-cased (A-Z) words between white space and one end per text.  Counts
are taken over all training texts.  The network's vocabulary is the most frequent words,
in classes of similar frequency; every other word belongs to the class of its last two
bytes and is told apart there by its smoothed count.  A text's score is the log10
probability of all its tokens, with the state carried through the whole text.

Training is one data-parallel pass: a hash deals the training texts to ``ROUNDS`` rounds,
in each of which every task trains the current network on its own texts of that round,
and the results are averaged, weighted by their tokens, in a tree of bounded groups.
Every token of every training text is thus learned from once, at every size of the input;
long texts are cut into segments that run side by side.  A task holds about
``_LEARN_TOKENS`` at once.

Scale.  Counting flushes bounded tables from each task and sums them by word.  Words from
a count up, at most ``DICTIONARY``, go to all tasks; a text's other words leave the scan
as a short list and are joined with the full counts, so any vocabulary size works.

Cases.  A null or empty text is one end token.  Without training texts every token has
probability 1 by the base formula, and the network gives the untrained distribution of
the end and unknown words.  Repeated rows are scored row by row."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gru
from .common import add_from_text, fold, fresh, ship, slices, split_text, store
from .hashing import HashTable, ranges_hash

END = b""
SMOOTH = 0.1
#: Words whose counts every task gets (about 30 MB in a worker).
DICTIONARY = 200_000
VOCABULARY, CLASS_WORDS = 1536, 64
ENDINGS = 32
ROUNDS = 3
RATES = (0.02, 0.012, 0.006)
_FLUSH = 300_000
#: Tokens that a task trains on at once, beyond a single longer text.
_LEARN_TOKENS = 1 << 22
#: Bytes of text that are looked up at once.
_AT_ONCE = 1 << 19
#: Bytes of words (1) and white space (0).
_WORD = np.ones(256, dtype=np.int8)
_WORD[[9, 10, 11, 12, 13, 32]] = 0
_FAN = 32


def tokens(text: bytes | None) -> list[bytes]:
    """Words, then the end."""
    return [*(text.lower().split() if text else ()), END]


def count_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, c) over all rows of ``docs``; the end is the empty word."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(text).cast("binary").alias("t"))

    def scan(batches):
        seen: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])
            seen.clear()
            return batch

        for batch in batches:
            for t in batch.column(0):
                seen.update(tokens(t.as_py()))
                if len(seen) > _FLUSH:
                    yield flush()
        yield flush()

    return rows.mapInArrow(scan, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Word numbers, classes and counts that every task gets."""

    def __init__(self, known: dict[bytes, int], n: int, v: int, endings: dict[bytes, tuple[int, int]]):
        """``known``: counts of frequent words; ``n``, ``v``: tokens and distinct words;
        ``endings``: last two bytes to (tokens, words) beyond the network's vocabulary,
        with the empty ending for all others."""
        self.known, self.n, self.v = known, n, v
        words = self.network_words(known)
        self.number = {w: i for i, w in enumerate(words)}
        self.endings = {e: k for k, e in enumerate(sorted({b"", *endings}))}
        size = len(words)
        start = np.array([*range(0, size, CLASS_WORDS), size] if size else [0], dtype=np.int64)
        self.layout = gru.Layout(start, len(start) - 1 + len(self.endings))
        tail = np.array([endings.get(e, (0, 0)) for e in self.endings], dtype=np.float64).reshape(-1, 2)
        self.tail_log = np.log10(tail[:, 0] + SMOOTH * (tail[:, 1] + 1))
        self.word_counts = np.array([known[w] for w in words], dtype=np.float64)
        fine = np.add.reduceat(self.word_counts, start[:-1]) if size else np.zeros(0)
        self.class_counts = np.concatenate([fine, tail[:, 0]])

    @staticmethod
    def network_words(known: dict[bytes, int]) -> list[bytes]:
        return sorted(known, key=lambda w: (-known[w], w))[:VOCABULARY]

    def network_ids(self, words: list[bytes]) -> np.ndarray:
        return _NetworkIds(self)(words)


class _Endings:
    """Input number of a word that the network does not know: its ending's."""

    def __init__(self, vocabulary: Vocabulary):
        self.first, self.places = len(vocabulary.number), vocabulary.endings

    def __call__(self, word: bytes) -> int:
        return self.first + self.places.get(word[-2:], self.places[b""])


class _NetworkIds:
    """Input numbers of words, without the dictionary of counts."""

    def __init__(self, vocabulary: Vocabulary):
        self.number, self.ending = vocabulary.number, _Endings(vocabulary)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        get, ending = self.number.get, self.ending
        return np.array([i if (i := get(w)) is not None else ending(w) for w in words], dtype=np.int64)


def build_vocabulary(counts: DataFrame) -> Vocabulary:
    """From the full counts table; what comes to the driver is bounded."""
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    # The least count of which the words fit the dictionary, from a table of count levels.
    level = F.floor(F.log2("c") * 16).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()
    least, fits = None, 0
    for r in sorted(levels, key=lambda r: -r["level"]):
        fits += r["words"]
        if fits > DICTIONARY:
            break
        least = r["level"]
    known = {} if least is None else {bytes(r["word"]): r["c"] for r in counts.where(level >= least).collect()}
    network = Vocabulary.network_words(known)
    inside = set(network)
    # Endings: at most 65,536 pairs of bytes; the vocabulary's share is taken off here.
    ending = F.substring("word", -2, 2)
    table = counts.groupBy(ending.alias("e")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    tail = {bytes(r["e"]): [r["n"], r["v"]] for r in table}
    for w in inside:
        tail[w[-2:]][0] -= known[w]
        tail[w[-2:]][1] -= 1
    top = sorted((e for e in tail if e and tail[e][1]), key=lambda e: (-tail[e][0], e))[: ENDINGS - 1]
    rest = [tail[e] for e in tail if e not in set(top)]
    endings = {e: tuple(tail[e]) for e in top} | {b"": (sum(x[0] for x in rest), sum(x[1] for x in rest))}
    return Vocabulary(known, total["n"] or 0, total["v"] or 0, endings)


def _average(vectors: list[tuple[float, np.ndarray]]) -> tuple[float, np.ndarray]:
    weight = sum(w for w, _ in vectors)
    return weight, sum(v.astype(np.float64) * (w / weight) for w, v in vectors).astype(np.float32)


def _tree_average(rows: DataFrame) -> np.ndarray | None:
    """Weighted mean of (weight, params) rows, ``_FAN`` at a time."""
    rows = store(rows, "trained")
    n = rows.count()
    while n > _FAN:

        def merge(key: tuple[Any, ...], part: pd.DataFrame) -> pd.DataFrame:
            w, v = _average([(w, np.frombuffer(b, dtype=np.float32)) for w, b in zip(part["weight"], part["params"], strict=True)])
            return pd.DataFrame({"weight": [w], "params": [v.tobytes()]})

        groups = -(-n // _FAN)
        rows = store(rows.groupBy(F.pmod(F.xxhash64("params"), F.lit(groups)).alias("g")).applyInPandas(merge, "weight double, params binary"), "trained")
        n = rows.count()
    got = [(r["weight"], np.frombuffer(bytes(r["params"]), dtype=np.float32)) for r in rows.orderBy("weight", "params").collect()]
    return _average(got)[1] if got else None


def _bounded(texts: Iterable[np.ndarray], most: int = _LEARN_TOKENS) -> Iterator[list[np.ndarray]]:
    """Lists of texts of at most ``most`` tokens (one text at least) that cover them all."""
    out: list[np.ndarray] = []
    n = 0
    for ids in texts:
        if out and n + len(ids) > most:
            yield out
            out, n = [], 0
        out.append(ids)
        n += len(ids)
    if out:
        yield out


def train(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> gru.Params:
    """Rounds of local training and averaging over ``docs`` (training rows only), each row
    in one round."""
    ship(docs.sparkSession)
    layout, ids_of = vocabulary.layout, _NetworkIds(vocabulary)
    params = gru.initial(layout, vocabulary.class_counts, vocabulary.word_counts)
    rows = docs.select(F.col(text).cast("binary").alias("t"))
    for k in range(ROUNDS):
        flat = params.flat
        mine = rows.where(F.pmod(F.xxhash64("t"), F.lit(ROUNDS)) == k)

        def scan(batches, flat=flat, rate=RATES[k]):
            p, n = gru.Params(layout, flat), 0
            for texts in _bounded(ids_of(tokens(t.as_py())) for batch in batches for t in batch.column(0)):
                p = gru.train(p, layout, texts, rate)
                n += sum(map(len, texts))
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([float(n)]), pa.array([p.flat.tobytes()], pa.binary())], names=["weight", "params"])

        mean = _tree_average(mine.mapInArrow(scan, "weight double, params binary"))
        if mean is not None:
            params = gru.Params(layout, mean)
    return params


def _scan_fields(vocabulary: Vocabulary, flat: np.ndarray):
    """What one scan of whole texts gives: counts, partial log10 sums, further words."""
    layout = vocabulary.layout
    base_log = float(np.log10(vocabulary.n + SMOOTH * (vocabulary.v + 1)))

    # One look-up per token, by a 64-bit hash: a word's place, or -1, leads to its numbers.
    places = sorted(vocabulary.known)
    logs = np.log10(np.array([vocabulary.known[w] for w in places] + [1.0]) + SMOOTH)
    logs[-1] = 0.0  # words beyond the dictionary come in later
    ids_of = vocabulary.network_ids(places)
    tail_log, n_words, ending, n_places = vocabulary.tail_log, len(vocabulary.number), _Endings(vocabulary), len(places)
    packed = b"\n".join(places)  # words hold no white space

    def make():
        p = gru.Params(layout, flat)
        raw = np.frombuffer(b"\n" + packed + b"\n", dtype=np.uint8)
        edges = np.flatnonzero(raw == 10)
        table = HashTable(n_places)
        if n_places:  # an empty place is the end of a text
            table.add(ranges_hash(raw, edges[:-1] + 1, edges[1:]))

        def look_up(parts, last):
            """Per part of a text: its network ids, log counts and words beyond the
            dictionary.  Words, and an empty range after a text's last part for its end,
            are byte ranges of all parts, which white space separates."""
            whole = b"".join([t + b" \n" for t in parts])
            raw = np.frombuffer(whole, dtype=np.uint8)
            closing = np.cumsum([len(t) + 2 for t in parts]) - 1
            change = np.flatnonzero(np.diff(_WORD[raw], prepend=0, append=0))
            ends_at = closing[np.array(last, dtype=bool)]
            starts, ends = np.concatenate([change[::2], ends_at]), np.concatenate([change[1::2], ends_at])
            order = np.argsort(starts, kind="stable")
            starts, ends = starts[order], ends[order]
            at = table.find(ranges_hash(raw, starts, ends))
            mine, log = ids_of[at] if n_places else np.zeros(len(at), dtype=np.int64), logs[at]
            gone = np.flatnonzero(at < 0)
            missing = [whole[a:b] for a, b in zip(starts[gone].tolist(), ends[gone].tolist(), strict=True)]
            mine[gone] = [ending(w) for w in missing]
            cut = np.searchsorted(starts, closing, side="right")[:-1]
            cut_gone = np.searchsorted(gone, cut).tolist()
            lists = [missing[a:b] for a, b in zip([0, *cut_gone], [*cut_gone, len(missing)], strict=True)]
            return list(zip(np.split(mine.astype(np.int32), cut), np.split(log, cut), lists, strict=True))

        def work(texts):
            parts, owner = [], []
            for i, t in enumerate(texts):
                of = list(split_text((t or b"").lower(), _AT_ONCE))
                parts += of
                owner += [i] * len(of)
            last = [a != b for a, b in zip(owner, [*owner[1:], -1], strict=True)]
            found: list[list] = [[] for _ in texts]
            for a, b in slices(np.array([len(x) for x in parts]), _AT_ONCE):
                for i, x in zip(owner[a:b], look_up(parts[a:b], last[a:b]), strict=True):
                    found[i].append(x)
            ids, n_tokens, n_known, base, tail, further = [], [], [], [], [], []
            for of in found:
                mine, log = (of[0][0], of[0][1]) if len(of) == 1 else (np.concatenate([x[k] for x in of]) for k in (0, 1))
                missing = Counter(w for x in of for w in x[2])
                beyond = mine >= n_words  # told apart by counts within their ending's class
                ids.append(mine)
                n_tokens.append(len(mine))
                n_known.append(len(mine) - missing.total())
                base.append(float(log.sum()) - len(mine) * base_log)
                tail.append(float((log[beyond] - tail_log[mine[beyond] - n_words]).sum()))
                further.append([{"word": w, "n": n} for w, n in missing.items()])
            ll = gru.score(p, layout, ids) / np.log(10)
            return [n_tokens, n_known, base, (ll + np.array(tail)).tolist(), further]

        return work

    fields = [
        ("n_tokens", "bigint", pa.int64()),
        ("n_known", "bigint", pa.int64()),
        ("base", "double", pa.float64()),
        ("lm", "double", pa.float64()),
        ("further", "array<struct<word:binary,n:bigint>>", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
    ]
    return fields, make


def score(docs: DataFrame, counts: DataFrame, vocabulary: Vocabulary, params: gru.Params, text: str = "text") -> DataFrame:
    """(columns of ``docs`` but ``text``, n_tokens, n_known, base_score, score)."""
    names = [c for c in docs.columns if c != text]
    packed = docs.select(F.struct(*[F.col(c) for c in names]).alias("row"), F.col(text).alias("text")).withColumn("rid", F.monotonically_increasing_id())
    fields, make = _scan_fields(vocabulary, params.flat)
    scanned = store(add_from_text(packed, fields, make, "text", as_bytes=True, slice_bytes=16 << 20).drop("text"), "scored")
    further = scanned.select("rid", F.explode("further").alias("x")).select("rid", F.col("x.word").alias("word"), F.col("x.n").alias("n"))
    found = further.join(counts, "word", "left").groupBy("rid").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known")
    )
    out = scanned.drop("further").join(found, "rid", "left")
    more = F.coalesce("more", F.lit(0.0))
    new = {"n_tokens": F.col("n_tokens"), "n_known": F.col("n_known") + F.coalesce("known", F.lit(0)), "base_score": F.col("base") + more, "score": F.col("lm") + more}
    return out.select(*(F.col("row")[c].alias(c) for c in names), *(v.alias(fresh(docs, k)) for k, v in new.items()))


def report(docs: DataFrame) -> DataFrame:
    """The query's result: one row per document with base and model scores."""
    docs = docs.select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 10) == 0
    learn = docs.where(~held_out)
    counts = store(count_tokens(learn), "counts")
    vocabulary = build_vocabulary(counts)
    params = train(learn, vocabulary)
    scored = score(docs, counts, vocabulary, params)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(vocabulary.n).cast("long").alias("train_tokens"), "base_score", "score"
    )
