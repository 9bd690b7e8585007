"""Benchmark decontamination: a broadcast hash set of benchmark word windows, a scan of
the training texts' windows, exact verification, and removal of spans or documents.

Words are the maximal runs of ASCII letters and digits and of all characters beyond
ASCII, with A-Z lower-cased.  A benchmark item of ``window`` words or more gives all its
windows of that many consecutive words; a shorter one (but not an empty one) is one
window.  A text's word is hit if it lies in any occurrence of any window.

Scale.  The texts are scanned once, without a shuffle, and rows pass through with all
their columns.  The benchmark is the broadcast side: its words are counted first, and
beyond ``MAX_BLOCK_WORDS`` it is dealt into blocks of about that size; each block is a
further narrow scan whose hits join those already found, so the result is the same for a
benchmark of any size.

Cases.  A null or empty text has no words and no hits.  Items that are null or have no
words give no windows; items with a null id give hits, but are not counted or listed.
Repeated texts and items are handled row by row; an id that several item rows share
counts once.  An empty benchmark leaves every text clean."""

from __future__ import annotations

import hashlib
import re
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_from_text, fresh, store

WINDOW = 10
#: Words of benchmark text that one broadcast block may hold (about 0.3 GB in a worker).
MAX_BLOCK_WORDS = 1_000_000

#: Bytes to keep as word bytes, A-Z lowered; all others become spaces.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FILTER_BITS = 20


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


class WindowSet:
    """Windows of one benchmark block, by length, with the ids of their items."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int):
        self.vocab: dict[bytes, int] = {}
        self.windows: dict[int, dict[tuple[int, ...], set]] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words(text)]
            if not ids:
                continue
            size = min(window, len(ids))
            of_size = self.windows.setdefault(size, {})
            for i in range(len(ids) - size + 1):
                of_size.setdefault(tuple(ids[i : i + size]), set()).add(item)
        self.factors = np.random.default_rng(5).integers(1, 1 << 62, window, dtype=np.uint64) * 2 + 1
        self.seen = {}
        for size, found in self.windows.items():
            keys = np.array(list(found), dtype=np.uint64)
            self.seen[size] = np.zeros(1 << _FILTER_BITS, dtype=bool)
            self.seen[size][self._slot(sum(keys[:, j] * self.factors[j] for j in range(size)))] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def occurrences(self, ids: np.ndarray):
        """(position, length, item ids) of every window in the word ids (0: not in the
        vocabulary): hash filter first, then the exact look-up."""
        u = ids.astype(np.uint64)
        for size, found in self.windows.items():
            n = len(u) - size + 1
            if n <= 0:
                continue
            h = u[:n] * self.factors[0]
            for j in range(1, size):
                h += u[j : j + n] * self.factors[j]
            for p in np.flatnonzero(self.seen[size][self._slot(h)]).tolist():
                items = found.get(tuple(ids[p : p + size].tolist()))
                if items:
                    yield p, size, items


def _scan_texts(block: WindowSet, texts: list[bytes | None]):
    """Per text: number of words, hit spans (word positions), item ids found."""
    lists = [words(t) for t in texts]
    starts = np.zeros(len(lists) + 1, dtype=np.int64)
    np.cumsum([len(w) + 1 for w in lists], out=starts[1:])  # a 0 between texts stops windows
    ids = np.zeros(int(starts[-1]), dtype=np.int64)
    get = block.vocab.get
    for a, w in zip(starts.tolist(), lists, strict=False):
        ids[a : a + len(w)] = np.fromiter(map(get, w, repeat(0)), dtype=np.int64, count=len(w))
    spans: list[list[dict]] = [[] for _ in lists]
    items: list[set] = [set() for _ in lists]
    found = sorted(((p, p + n, at) for p, n, at in block.occurrences(ids)), key=lambda x: x[:2])
    owner = np.searchsorted(starts, [p for p, _, _ in found], side="right") - 1
    for (p, end, at), k in zip(found, owner.tolist(), strict=True):
        a, b = p - int(starts[k]), end - int(starts[k])
        items[k].update(i for i in at if i is not None)
        if spans[k] and a <= spans[k][-1]["end"]:
            spans[k][-1]["end"] = max(b, spans[k][-1]["end"])
        else:
            spans[k].append({"start": a, "end": b})
    return [len(w) for w in lists], spans, [sorted(s) for s in items]


def _blocks(benchmark: DataFrame, item_id: str, text: str, max_words: int):
    """The benchmark as lists of (id, text), each of about ``max_words`` words at most
    (or one item, if that is longer)."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("binary").alias("text"))
    items = items.where(F.col("text").isNotNull())
    n_words = items.agg(F.sum(F.size(F.split(F.col("text").cast("string"), "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"))).alias("n")).first()["n"] or 0
    n = max(1, -(-2 * n_words // max_words)) if n_words > max_words else 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r["item"], bytes(r["text"])) for r in part.collect()]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_block_words: int = MAX_BLOCK_WORDS,
    into: str = "contamination",
) -> DataFrame:
    """All columns of ``docs`` plus the struct ``into`` with ``n_words``, ``spans`` (hit
    word ranges, merged, end exclusive) and ``items`` (sorted ids with occurrences, in
    the type they have in ``benchmark``).

    Between blocks the result is stored, so a task holds one block's windows at a time."""
    id_type = benchmark.schema[item_id].dataType.simpleString()
    plain, into = docs.columns, fresh(docs, into)
    n_col, s_col, i_col = (fresh(docs, f"{into}_{x}") for x in ("n", "spans", "items"))
    out = docs.withColumns(
        {
            n_col: F.lit(0).cast("long"),
            s_col: F.array().cast("array<struct<start:bigint,end:bigint>>"),
            i_col: F.array().cast("array<string>"),
        }
    )
    fields = [
        ("new_n", "bigint", pa.int64()),
        ("new_spans", "array<struct<start:bigint,end:bigint>>", _SPAN),
        ("new_items", "array<string>", pa.list_(pa.string())),
    ]
    first = True
    for items in _blocks(benchmark, item_id, item_text, max_block_words):
        if not first:
            out = store(out, "contamination")

        def make(items=items):
            block = WindowSet(items, window)
            return lambda texts: _scan_texts(block, texts)

        named = [(fresh(out, name), kind, arrow) for name, kind, arrow in fields]
        scanned = add_from_text(out, named, make, text, as_bytes=True)
        new_n, new_s, new_i = (F.col(x) for x, _, _ in named)
        if not first:
            new_s = F.when(F.size(new_s) == 0, F.col(s_col)).otherwise(_merged(F.concat(s_col, new_s)))
            new_i = F.array_union(i_col, new_i)
        out = scanned.select(*plain, new_n.alias(n_col), new_s.alias(s_col), new_i.alias(i_col))
        first = False
    packed = F.struct(F.col(n_col).alias("n_words"), F.col(s_col).alias("spans"), F.array_sort(F.col(i_col).cast(f"array<{id_type}>")).alias("items"))
    return out.select(*plain, packed.alias(into))


def _merged(spans: F.Column) -> F.Column:
    """Spans sorted, those that meet made one."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(out, s):
        last = F.try_element_at(out, F.lit(-1))
        both = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        meets = (F.size(out) > 0) & (s["start"] <= F.try_element_at(out, F.lit(-1))["end"])
        return F.when(meets, F.concat(F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))), F.array(both))).otherwise(F.concat(out, F.array(s)))

    return F.aggregate(F.array_sort(spans), none, add)


def n_hit(found) -> F.Column:
    """Number of hit words of the struct column that ``find_contamination`` adds."""
    return F.aggregate(found["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def _cut(texts: list[bytes | None], spans: list) -> list[str | None]:
    """Texts without their hit words and what stands between hit words of a span."""
    out: list[str | None] = []
    for text, hit in zip(texts, spans, strict=True):
        if text is None or hit is None or len(hit) == 0:
            out.append(None if text is None else text.decode("utf-8", "replace"))
            continue
        at = [m.span() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", text)]
        kept, last = [], 0
        for s in hit:
            kept.append(text[last : at[s["start"]][0]])
            last = at[s["end"] - 1][1]
        kept.append(text[last:])
        out.append(b"".join(kept).decode("utf-8", "replace"))
    return out


def remove_documents(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the rows that hold any benchmark window."""
    into = fresh(docs, "contamination")
    found = find_contamination(docs, benchmark, into=into, **how)
    return found.where(F.size(F.col(into)["spans"]) == 0).drop(into)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` with every hit span cut out of ``text``; other columns stay as they are."""
    into = fresh(docs, "contamination")
    found = find_contamination(docs, benchmark, text=text, into=into, **how)
    cut = F.pandas_udf(lambda t, s: pd.Series(_cut([None if x is None else x.encode() for x in t], list(s))), "string")
    hit = F.size(F.col(into)["spans"]) > 0
    return found.withColumn(text, F.when(hit, cut(F.col(text), F.col(into)["spans"])).otherwise(F.col(text))).select(*docs.columns)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The query's digest: one row per document with counts and the items' checksum."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    c = F.col("contamination")
    names = F.array_sort(F.transform(c["items"], lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        n_hit(c).alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(c["spans"]) > 0).alias("contaminated"),
    )


def checksum(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
