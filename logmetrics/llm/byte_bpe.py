"""Byte-level BPE encoding and decoding, with merges chosen by a segment tree.

A text is split by a pattern, and each match is encoded by itself.  A match that is a
token is that token.  Any other starts as single bytes: the leaves of a segment tree
stand for byte positions and hold the rank of the pair that starts there (none, where no
live token starts or its pair is no token), every inner node holds the least below it,
and of equal ranks the leftmost.  The root thus names the next merge.  A merge rewrites
three leaves - the merged token, the one it swallowed and its live neighbour to the left -
and the ways above them, so a match of n bytes takes O(n log n) steps however long it is.
Decoding joins the bytes of the ids.

Scale.  Both ways are narrow scans in Arrow batches, cut into slices of bytes; no rows are
shuffled.  The vocabulary travels once as a broadcast of its file (under ``MOST_BYTES``,
which is checked).  The matches of a slice that are new become a forest of segment trees of
equal size in numpy, in which every round makes one merge in each tree; longer matches get
a tree each.  A worker remembers up to ``CACHE`` short matches; results do not depend on
it.  Matches of very long texts come in portions.

Cases.  A null or empty text has no ids, which decode to no bytes; null ids likewise.
Repeated rows are encoded one by one.  An id that is no token is an error.  An empty table
gives no rows.  Result columns whose name is taken get underscores added."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_from_text, fresh, ship, slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Largest vocabulary file that is broadcast.
MOST_BYTES = 64 << 20
#: Matches a Python worker remembers, and the longest of them, in characters.
CACHE, CACHED_CHARS = 400_000, 48
#: Bytes beyond which a match gets a tree of its own; leaves of a forest of shorter ones.
LONG, FOREST = 256, 1 << 19
#: Characters of texts whose matches are looked up at once; a longer text gives its
#: matches in portions of ``PORTION``.
WHOLE_CHARS, PORTION = 1 << 20, 1 << 16

_NONE = 1 << 62  # a leaf without a pair


class Codec:
    """Ranks (token bytes to id) and a pattern, as encoder and decoder."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache: int = CACHE):
        import regex

        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.single = [ranks.get(bytes([b])) for b in range(256)]
        size = max(ranks.values(), default=-1) + 1
        self.tokens: list[bytes | None] = [None] * size
        for token, i in ranks.items():
            self.tokens[i] = token
        self.cache = cache
        self._seen: dict[str, list[int]] = {}
        self._single = np.array([-1 if i is None else i for i in self.single], dtype=np.int64)
        # All pairs of tokens whose bytes are a token, as one number each.
        splits = ((ranks.get(t[:k]), ranks.get(t[k:]), i) for t, i in ranks.items() for k in range(1, len(t)))
        found = sorted((a * size + b, i) for a, b, i in splits if a is not None and b is not None) or [(-1, 0)]
        self._pairs, self._merged = np.array(found, dtype=np.int64).T.copy()

    def merge(self, piece: bytes) -> list[int]:
        """Ids of ``piece`` by merging the leftmost pair of the least rank, again and again."""
        n = len(piece)
        ids = [self.single[b] for b in piece]
        if None in ids:
            raise ValueError("the vocabulary lacks a byte")
        if n < 2:
            return ids
        bits = (n - 1).bit_length()
        size, low = 1 << bits, (1 << bits) - 1
        tokens, ranks = self.tokens, self.ranks
        after = list(range(1, n + 1))  # next live position; n at the end
        before = list(range(-1, n - 1))
        tree = [_NONE] * (2 * size)
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                tree[size + i] = rank << bits | i
        for at in range(size - 1, 0, -1):
            left, right = tree[2 * at], tree[2 * at + 1]
            tree[at] = left if left < right else right

        def put(i: int, value: int) -> None:
            at = size + i
            tree[at] = value
            at >>= 1
            while at:
                left, right = tree[2 * at], tree[2 * at + 1]
                least = left if left < right else right
                if tree[at] == least:
                    return
                tree[at] = least
                at >>= 1

        def pair(i: int, j: int) -> int:
            rank = ranks.get(tokens[ids[i]] + tokens[ids[j]])
            return _NONE if rank is None else rank << bits | i

        while tree[1] != _NONE:
            i = tree[1] & low
            ids[i] = tree[1] >> bits
            gone = after[i]
            j = after[i] = after[gone]
            if j < n:
                before[j] = i
            put(gone, _NONE)
            put(i, pair(i, j) if j < n else _NONE)
            h = before[i]
            if h >= 0:
                put(h, pair(h, i))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens; ``_NONE`` where their bytes are no token."""
        key = a * len(self.tokens) + b
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where(self._pairs[at] == key, self._merged[at], _NONE)

    def merge_many(self, pieces: list[bytes]) -> list[list[int]]:
        """``merge`` of many short pieces at once: a forest of trees of one size, in which
        every round makes the next merge of each tree that has one."""
        out: list[list[int]] = [[] for _ in pieces]
        sizes: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if len(piece) > LONG:
                out[k] = self.merge(piece)
            else:
                sizes.setdefault(max(1, (len(piece) - 1).bit_length()), []).append(k)
        for bits, of in sizes.items():
            for at in range(0, len(of), FOREST >> bits):
                part = of[at : at + (FOREST >> bits)]
                for k, ids in zip(part, self._forest([pieces[k] for k in part], bits), strict=True):
                    out[k] = ids
        return out

    def _forest(self, pieces: list[bytes], bits: int) -> list[list[int]]:
        size, low = 1 << bits, (1 << bits) - 1
        length = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), dtype=np.uint8).reshape(-1, size)
        spot = np.arange(size)
        live = spot < length[:, None]
        ids = self._single[raw]
        if (ids[live] < 0).any():
            raise ValueError("the vocabulary lacks a byte")
        after = np.broadcast_to(spot + 1, raw.shape).copy()
        before = after - 2
        tree = np.full((len(pieces), 2 * size), _NONE)
        first = self.pairs(ids[:, :-1], ids[:, 1:])
        first[first != _NONE] <<= bits
        tree[:, size:-1] = np.where(live[:, 1:] & (first != _NONE), first | spot[:-1], _NONE)
        for at in range(bits - 1, -1, -1):
            below = tree[:, 2 << at : 4 << at]
            tree[:, 1 << at : 2 << at] = np.minimum(below[:, ::2], below[:, 1::2])
        r = np.flatnonzero(tree[:, 1] != _NONE)
        while len(r):
            i = tree[r, 1] & low
            ids[r, i] = tree[r, 1] >> bits
            gone = after[r, i]
            j = after[r, i] = after[r, gone]
            live[r, gone] = False
            more = j < length[r]
            before[r[more], j[more]] = i[more]
            h = before[r, i]
            less = h >= 0
            tree[r, size + gone] = _NONE
            tree[r, size + i] = _NONE
            tree[r[more], size + i[more]] = self._leaves(ids, r[more], i[more], j[more], bits)
            tree[r[less], size + h[less]] = self._leaves(ids, r[less], h[less], i[less], bits)
            ways = [size + gone, size + i, size + np.where(less, h, i)]
            for _ in range(bits):
                ways = [w >> 1 for w in ways]
                for w in ways:
                    tree[r, w] = np.minimum(tree[r, 2 * w], tree[r, 2 * w + 1])
            r = r[tree[r, 1] != _NONE]
        flat, ends = ids[live].tolist(), np.cumsum(live.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _leaves(self, ids: np.ndarray, r: np.ndarray, i: np.ndarray, j: np.ndarray, bits: int) -> np.ndarray:
        rank = self.pairs(ids[r, i], ids[r, j])
        return np.where(rank == _NONE, _NONE, (rank & (_NONE - 1)) << bits | i)

    def _learn(self, new: list[str]) -> dict[str, list[int]]:
        """Ids of matches: the token it is, or merges."""
        raw = [m.encode() for m in new]
        whole = [self.ranks.get(r) for r in raw]
        merged = iter(self.merge_many([r for r, w in zip(raw, whole, strict=True) if w is None]))
        return {m: next(merged) if w is None else [w] for m, w in zip(new, whole, strict=True)}

    def _matches(self, text: str) -> Iterator[list[str]]:
        if len(text) <= WHOLE_CHARS:
            yield self.pattern.findall(text)
            return
        found = self.pattern.finditer(text)
        while part := [m.group() for m in islice(found, PORTION)]:
            yield part

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        out = []
        for a, b in slices(np.array([len(t or "") for t in texts], dtype=np.int64), WHOLE_CHARS):
            if b - a == 1:  # it may be a long one
                parts = [self._ids([m])[0] for m in self._matches(texts[a] or "")]
                out.append(np.concatenate([np.zeros(0, np.int32), *parts]))
            else:
                out += self._ids([self.pattern.findall(t or "") for t in texts[a:b]])
        return out

    def _ids(self, matches: list[list[str]]) -> list[np.ndarray]:
        new = set().union(*matches).difference(self._seen)
        known = self._seen
        if new:
            learned = self._learn(list(new))
            short = {m: ids for m, ids in learned.items() if len(m) <= CACHED_CHARS}
            if len(known) + len(short) > self.cache:
                known = {m: known[m] for ms in matches for m in ms if m in known}
                self._seen = dict(islice(known.items(), self.cache))
            self._seen.update(islice(short.items(), max(0, self.cache - len(self._seen))))
            known = known | learned if len(self._seen) < len(known) + len(learned) else self._seen
        return [np.fromiter(chain.from_iterable(map(known.__getitem__, ms)), np.int32) for ms in matches]

    def table(self) -> tuple[pa.Array, pa.Array]:
        """All ids in rising order and their bytes, for decoding in Arrow."""
        have = [i for i, t in enumerate(self.tokens) if t is not None]
        return pa.array(have, pa.int32()), pa.array([self.tokens[i] for i in have], pa.large_binary())


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """A vocabulary file: lines of a token in base 64 and its rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


_CODECS: dict[tuple[int, str], Codec] = {}


def _codec(vocabulary, pattern: str) -> Codec:
    """One codec per Python worker and vocabulary: its table outlives a task."""
    key = (vocabulary.value[0], pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(read_ranks(vocabulary.value[1]), pattern)
    return _CODECS[key]


def vocabulary_of(spark: SparkSession, path: str | None = None):
    """The vocabulary file at ``path`` (by default the public one of many languages), read
    by the driver, as a broadcast of a key and its bytes."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    raw = Path(path).read_bytes()
    if len(raw) > MOST_BYTES:
        raise ValueError(f"{path} holds more than {MOST_BYTES} bytes")
    return spark.sparkContext.broadcast((hash(raw), raw))


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode(docs: DataFrame, text: str = "text", vocabulary=None, pattern: str | None = None) -> DataFrame:
    """``docs`` plus ``ids``, the token ids of its text."""
    vocabulary = vocabulary or vocabulary_of(docs.sparkSession)
    pattern = pattern or default_pattern()

    def make():
        codec = _codec(vocabulary, pattern)

        def work(texts):
            ids = codec.encode(texts)
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate([np.zeros(0, np.int32), *ids])
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))]

        return work

    return add_from_text(docs, [("ids", "array<int>", pa.list_(pa.int32()))], make, text)


def decode(rows: DataFrame, ids: str = "ids", vocabulary=None, pattern: str | None = None) -> DataFrame:
    """``rows`` plus ``decoded``, the bytes its ids stand for."""
    ship(rows.sparkSession)
    vocabulary = vocabulary or vocabulary_of(rows.sparkSession)
    pattern = pattern or default_pattern()
    schema = T.StructType([*rows.schema.fields]).add(fresh(rows, "decoded"), T.BinaryType())
    at = rows.columns.index(ids)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tokens = _codec(vocabulary, pattern).table()
        known = known.to_numpy()
        for batch in batches:
            column = batch.column(at)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            place = np.searchsorted(known, flat)
            if len(flat) and (len(known) == 0 or (known[np.minimum(place, len(known) - 1)] != flat).any()):
                raise ValueError("an id that is no token")
            parts = tokens.take(pa.array(place))
            joined = np.frombuffer(parts.buffers()[1] or b"", dtype=np.int64)[: len(parts) + 1]
            ends = joined[np.concatenate([[0], np.cumsum(sizes)])] if len(flat) else np.zeros(len(sizes) + 1, np.int64)
            raw = parts.buffers()[2] or pa.py_buffer(b"")
            made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.tobytes()), raw])
            yield pa.RecordBatch.from_arrays([*batch.columns, made.cast(pa.binary())], names=schema.names)

    return rows.mapInArrow(scan, schema)


def report(docs: DataFrame) -> DataFrame:
    """The query's result: digests of the ids and of the bytes they decode to."""
    vocabulary = vocabulary_of(docs.sparkSession)
    coded = decode(encode(docs.select("doc_id", "text"), vocabulary=vocabulary).select("doc_id", "ids"), vocabulary=vocabulary)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
