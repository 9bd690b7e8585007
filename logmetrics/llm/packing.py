"""Best-fit packing by swap-based local search.

Every text becomes its token ids and one end id; only longer ones are cut, into pieces of
``CAPACITY`` tokens.  Pieces are dealt by a hash into groups of about ``GROUP`` pieces.
Within a group, best fit in falling order of length gives the first bins; then documents
move, or are exchanged one for one or two for one, between any two underfull bins whenever
that raises the sum of squared fills, so that weak bins drain until they are empty.  The
search ends when no step is left, or when no fewer bins can hold the tokens.

Scale.  Tokenising is one narrow scan; a bounded cache of words makes it cheap.  What is
shuffled afterwards is one short row per piece.  A group is bounded whatever the input,
the number of groups grows with it, and each gives away less than one bin on average.

Exactness of the cache: the tokenizer lower-cases a text, splits it by a pattern, drops
white space, and encodes what is left piece by piece.  Texts of Latin-1 characters, which
its normal form leaves alone, are split here by the same pattern and looked up by a 64-bit
hash; texts with other characters, an apostrophe (it may start a contraction) or a special
token's string go through it whole.

Cases.  A null or empty text is the end id alone.  Repeated rows are packed one by one.
Ties go to the longer, then to the smaller id.  An empty table gives no rows."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_from_text, fresh, ship, slices, split_text, store
from .hashing import HashTable, ranges_hash

CAPACITY = 2048
END_ID = 0
GROUP = 8192
#: Places for pieces in a task's table of token ids (about 40 bytes each).
CACHE_PIECES = 2_000_000
#: Bytes of text that are looked up at once; they stay in the processor's cache.
_AT_ONCE = 1 << 19
TOKENIZER = "word_bpe_49k.json"


# How the tokenizer's pattern sorts Latin-1 characters in lower case: white
# space (0), letters (1) and all else (3) come in runs, digits (2) alone.
_KIND = np.full(256, 3, dtype=np.uint8)
_KIND[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = 0
_KIND[[*range(0x61, 0x7B), 0xAA, 0xB5, 0xBA, *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = 1
_KIND[[*range(0x30, 0x3A), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = 2


class Encoder:
    """Texts to token ids as little-endian 32-bit bytes, by way of a table of pieces."""

    def __init__(self, path: str | None = None, capacity: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.capacity = capacity
        self._clear()

    def _clear(self) -> None:
        self.table = HashTable(self.capacity)
        self.at = np.zeros(1024, dtype=np.int64)  # entry -> place of its ids
        self.size = np.zeros(1024, dtype=np.int64)
        self.ids = np.zeros(4096, dtype="<u4")
        self.n_ids = 0

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, h: np.ndarray, ids: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        flat = np.concatenate(ids) if ids else np.zeros(0, dtype="<u4")
        n = self.table.n
        for name, used, more in (("at", n, len(ids)), ("size", n, len(ids)), ("ids", self.n_ids, len(flat))):
            old = getattr(self, name)
            if used + more > len(old):
                setattr(self, name, np.concatenate([old[:used], np.zeros(max(used, more) + more, dtype=old.dtype)]))
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        self.at[n : n + len(ids)] = self.n_ids + np.cumsum(sizes) - sizes
        self.size[n : n + len(ids)] = sizes
        self.table.add(h)
        self.n_ids += len(flat)

    def _learn(self, words: list[str]) -> list[np.ndarray]:
        """Ids of new pieces: letters many in one text, whose tokens are dealt back by
        the word number the tokenizer gives them; the rest one by one."""
        found: dict[str, np.ndarray] = {}
        letters = [w for w in words if w.isalpha()]
        for i in range(0, len(letters), 4000):
            part = letters[i : i + 4000]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids, word = np.array(e.ids, dtype="<u4"), np.array(e.word_ids)
            ends = [0, *(np.flatnonzero(np.diff(word)) + 1).tolist(), len(ids)]
            if len(ends) == len(part) + 1:
                found.update((w, ids[a:b]) for w, a, b in zip(part, ends, ends[1:], strict=False))
        rest = [w for w in words if w not in found]
        found.update((w, np.frombuffer(x, dtype="<u4")) for w, x in zip(rest, self._raw(rest), strict=True))
        return [found[w] for w in words]

    def _plain(self, text: str) -> bytes | None:
        """The text in lower case as Latin-1, if it then splits by ``_KIND`` alone: no
        other characters, no special token, and no apostrophe, which may start a
        contraction."""
        if "'" in text or any(s in text for s in self.special):
            return None
        try:
            return text.lower().encode("latin-1")
        except UnicodeEncodeError:
            return None

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes; long plain texts go in parts,
        which white space separates, so tables stay small."""
        out: list[bytes] = []
        parts, owner = [], []
        for i, t in enumerate(texts):
            plain = self._plain(t or "")
            out.append(self._raw([t])[0] if plain is None else b"")
            of = [] if plain is None else list(split_text(plain, _AT_ONCE))
            parts += of
            owner += [i] * len(of)
        found: list[list[bytes]] = [[] for _ in texts]
        for a, b in slices(np.array([len(x) for x in parts], dtype=np.int64), _AT_ONCE):
            for i, x in zip(owner[a:b], self._encode_plain(parts[a:b]), strict=True):
                found[i].append(x)
        return [b"".join(f) if f else o for f, o in zip(found, out, strict=True)]

    def _encode_plain(self, texts: list[bytes]) -> list[bytes]:
        if self.table.n > self.capacity // 2:
            self._clear()
        whole = b"\n".join([*texts, b""])
        raw = np.frombuffer(whole, dtype=np.uint8)
        kind = _KIND[raw]
        change = np.ones(len(raw) + 1, dtype=bool)
        np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
        change[1:-1] |= kind[1:] == 2
        starts = np.flatnonzero(change[:-1] & (kind > 0))
        ends = np.flatnonzero(change[1:] & (kind > 0)) + 1
        h = ranges_hash(raw, starts, ends)
        entry = self.table.find(h)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            new, first = np.unique(h[missing], return_index=True)
            if self.table.n + len(new) > self.capacity:  # one text beyond the table
                return self._raw([t.decode("latin-1") for t in texts])
            spots = missing[first]
            self._add(new, self._learn([whole[a:b].decode("latin-1") for a, b in zip(starts[spots].tolist(), ends[spots].tolist(), strict=True)]))
            entry[missing] = self.table.find(h[missing])
        size = self.size[entry]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(self.at[entry] - upto[:-1], size) + np.arange(upto[-1])]
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        cut = upto[np.searchsorted(starts, text_ends)].tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *cut], cut, strict=False)]


_ENCODERS: dict[str | None, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """One encoder per Python worker: its cache outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_PIECE = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint{}>>"


def pieces(docs: DataFrame, text: str = "text", capacity: int = CAPACITY, with_ids: bool = False, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: the columns of ``docs`` but ``text``, then ``piece`` (from 0),
    ``start``, ``length``, ``ids_crc32`` and, on request, the token ``ids``."""
    kept = [c for c in docs.columns if c != text]
    into, rest = fresh(docs, "pieces"), docs.select(*kept)
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    kind = pa.list_(pa.struct(fields))
    end = np.array([END_ID], dtype="<u4").tobytes()

    def make():
        enc = encoder(tokenizer)

        def work(texts):
            out = []
            for raw in enc.encode(texts):
                raw += end
                cut = []
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    row = {"piece": k, "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                    if with_ids:
                        row["ids"] = np.frombuffer(part, dtype="<u4").astype("i4")
                    cut.append(row)
                out.append(cut)
            return [out]

        return work

    found = add_from_text(docs, [(into, _PIECE.format(",ids:array<int>" if with_ids else ""), kind)], make, text, slice_bytes=_AT_ONCE)
    return found.select(*kept, F.explode(into).alias(into)).select(*kept, *(F.col(into)[n].alias(fresh(rest, n)) for n, _ in fields))


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Bin number of each length (1 to ``capacity``): best fit in falling order, then
    local search on the underfull bins."""
    lengths = np.asarray(lengths, dtype=np.int64)
    bin_of = np.full(len(lengths), -1, dtype=np.int64)
    space: list[tuple[int, int]] = []  # (free, bin), sorted
    n_bins = 0
    for i in np.lexsort((np.arange(len(lengths)), -lengths)).tolist():
        size = int(lengths[i])
        at = bisect_left(space, (size, -1))
        if at < len(space):
            free, b = space.pop(at)
        else:
            free, b, n_bins = capacity, n_bins, n_bins + 1
        bin_of[i] = b
        if free > size:
            insort(space, (free - size, b))
    if n_bins > -(-int(lengths.sum()) // capacity):
        _Search(lengths, bin_of, capacity).run()
    return np.unique(bin_of, return_inverse=True)[1] if len(bin_of) else bin_of


class _Search:
    """Steps that raise the sum of squared fills: from an underfull bin, one or two
    documents go to a fuller one that has room, in exchange for a shorter one or none.

    Giving d tokens from fill f to fill g raises the sum by 2 d (g - f + d).  As lengths
    are whole numbers up to the capacity, a table of what one or two documents of the
    giving bin add up to finds the longest that fits each partner in one look-up, for all
    partners at once.  The sum only rises, so the search ends by itself: when all bins are
    empty that can be, or when no bin has a step left."""

    def __init__(self, lengths: np.ndarray, bin_of: np.ndarray, capacity: int):
        self.lengths, self.bin_of, self.capacity = lengths, bin_of, capacity
        self.fill = np.bincount(bin_of, weights=lengths).astype(np.int64)
        self.members: list[list[int]] = [[] for _ in self.fill]
        for i, b in enumerate(bin_of.tolist()):
            self.members[b].append(i)
        self.least = -(-int(lengths.sum()) // capacity)

    def run(self) -> None:
        used = int((self.fill > 0).sum())
        moved = True
        while moved and used > self.least:
            moved = False
            for b in np.argsort(self.fill, kind="stable").tolist():
                while 0 < self.fill[b] < self.capacity and used > self.least and self._step(b):
                    moved = True
                    used -= int(self.fill[b] == 0)

    def _step(self, b: int) -> bool:
        """The best step that gives from bin ``b``, if there is one."""
        f, mine = int(self.fill[b]), self.members[b]
        # Partners: documents of underfull bins that are as full or fuller, and their room.
        others = (self.fill >= f) & (self.fill < self.capacity)
        others[b] = False
        bins = np.flatnonzero(others)
        if not len(bins):
            return False
        docs = np.flatnonzero(others[self.bin_of])
        back = np.concatenate([np.zeros(len(bins), dtype=np.int64), self.lengths[docs]])  # none, or one document
        to = np.concatenate([bins, self.bin_of[docs]])
        sizes = np.unique(self.lengths[mine])
        twice = np.unique(self.lengths[mine], return_counts=True)[1] > 1
        best = np.zeros(self.capacity + 1, dtype=np.int64)
        pairs = np.add.outer(sizes, sizes)
        pairs = np.concatenate([pairs[np.triu_indices(len(sizes), 1)], 2 * sizes[twice]])
        best[sizes] = sizes
        pairs = pairs[pairs <= self.capacity]
        best[pairs] = pairs
        best = np.maximum.accumulate(best)  # the largest that fits
        room = self.capacity - self.fill[to] + back
        given = best[np.minimum(room, self.capacity)]
        d = given - back
        gain = np.where(d > 0, 2 * d * (self.fill[to] - f + d), 0)
        k = int(gain.argmax())
        if gain[k] <= 0:
            return False
        out = self._of_size(mine, int(given[k]))
        self._shift(out, b, int(to[k]))
        if k >= len(bins):
            self._shift([int(docs[k - len(bins)])], int(to[k]), b)
        return True

    def _of_size(self, mine: list[int], size: int) -> list[int]:
        first: dict[int, int] = {}
        for i in mine:
            n = int(self.lengths[i])
            if n == size:
                return [i]
            if size - n in first:
                pair = [first[size - n], i]
            first.setdefault(n, i)
        return pair

    def _shift(self, docs: list[int], src: int, dst: int) -> None:
        for i in docs:
            self.members[src].remove(i)
            self.members[dst].append(i)
            self.bin_of[i] = dst
        n = int(self.lengths[docs].sum())
        self.fill[src] -= n
        self.fill[dst] += n


def assign(parts: DataFrame, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece"), capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``parts`` plus ``sequence_id`` and ``offset``: its bin and its place there.

    ``parts`` is read twice (a count, then the packing), so store it before."""
    ship(parts.sparkSession)
    n_groups = max(1, round(parts.count() / group))
    key, seq, off = (fresh(parts, c) for c in ("grp", "sequence_id", "offset"))
    dealt = parts.withColumn(key, F.pmod(F.xxhash64(*order, length), F.lit(n_groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema) + f", `{seq}` bigint, `{off}` bigint"

    def work(keys: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([*order, length], kind="stable").reset_index(drop=True)
        bins = pack(rows[length].to_numpy(), capacity)
        rows[seq] = bins * n_groups + keys[0]
        rows = rows.iloc[np.argsort(bins, kind="stable")]
        rows[off] = rows.groupby(seq)[length].cumsum() - rows[length]
        return rows.drop(columns=key)

    return dealt.groupBy(key).applyInPandas(work, schema)


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Token sequences of pieces that carry ``ids``: at most ``capacity`` ids a row."""
    one = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(one.alias("p")).select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))


def report(docs: DataFrame) -> DataFrame:
    """The query's result: one row per piece with its sequence and place."""
    return assign(store(pieces(docs.select("doc_id", "text")), "pieces"))
