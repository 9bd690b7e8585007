"""Periodic runs of words: branching tandem repeats found on an enhanced suffix array.

A run is a stretch of words with smallest period q that no neighbouring word extends; it
is reported if its length is at least ``LEAST_LENGTH`` and ``LEAST_PERIODS`` times q.

Words become numbers, and the texts of a slice are sorted together: suffixes by prefix
doubling, each text for itself.  The ranks of every doubling are kept; they give the
common prefixes of neighbours in the suffix array, and how far two places agree to the
left.  LCP intervals are never built as a tree: the next smaller common prefix on either
side of each place, found by pointer jumping, names an interval and cuts it into its
children.  The suffixes of all children but the largest are tested: if i + depth or
i - depth has its inverse-suffix-array entry within the interval, there is a square of
that root, and it is branching if the word after it differs from the word one depth
before.  A branching square ends where its run ends; rotated to the left as far as the
words agree it gives the run's start.  Runs with the same stretch are one, of the smallest
period: a multiple of a period is found as well, but covers the same words.

Scale.  One narrow scan in Arrow batches; n words take O(n log n) numpy steps and nothing
per word in Python but splitting and numbering.  A slice holds ``SLICE`` bytes of text, or
one longer text whole, since a run may span all of it.  No rows are shuffled.

Cases.  Null, empty and blank texts have no runs, and collapse to the empty text.  Ties
among the greatest go to the smallest start, then period.  Repeated rows are worked one by
one; an empty table gives no rows.  Taken column names get underscores added."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_from_text, fresh

LEAST_LENGTH, LEAST_PERIODS = 6, 4
SLICE = 1 << 20
#: Suffixes of smaller children that are tested at once.
AT_ONCE = 1 << 20


class Suffixes:
    """Suffix array of several texts at once, each sorted for itself.

    ``words`` are numbers; text k is ``words[bounds[k]:bounds[k + 1]]``."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        self.n = n = len(words)
        self.words = words
        sizes = np.diff(bounds)
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        self.first = np.repeat(bounds[:-1], sizes)
        self.end = np.repeat(bounds[1:], sizes)
        self.levels: list[np.ndarray] = []  # ranks by the first 1, 2, 4, ... words
        key = self.text * (int(words.max(initial=0)) + 1) + words
        order = np.argsort(key, kind="stable")
        rank = self._ranks(order, key[order])
        step = 1
        while True:
            self.levels.append(rank.astype(np.int32))
            size = np.bincount(rank, minlength=n)  # a rank is the place of its first suffix
            open_ = order[size[rank[order]] > 1]
            if not len(open_):
                break
            at = open_ + step
            # What is too short to have further words sorts first.
            second = np.where(at < self.end[open_], rank[np.minimum(at, n - 1)] + 1, 0)
            again = np.lexsort((second, rank[open_]))
            open_, second = open_[again], second[again]
            old = rank[open_]
            new = np.ones(len(open_), dtype=bool)
            new[1:] = (old[1:] != old[:-1]) | (second[1:] != second[:-1])
            starts = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            # Place of a subgroup: that of its group plus its distance to the group's start.
            head = np.ones(len(open_), dtype=bool)
            head[1:] = old[1:] != old[:-1]
            base = np.maximum.accumulate(np.where(head, np.arange(len(open_)), 0))
            place = old + starts[group] - base
            order[old + np.arange(len(open_)) - base] = open_
            rank = rank.copy()
            rank[open_] = place
            step *= 2
        self.sa, self.isa = order, rank

    @staticmethod
    def _ranks(order: np.ndarray, key: np.ndarray) -> np.ndarray:
        new = np.ones(len(order), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        return rank

    def agree(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many words agree from places ``a`` and ``b`` of one text on to the right
        (``step`` 1), or before them to the left (``step`` -1).

        Equal ranks at a level mean that as many words follow and agree.  The last level
        has no equal ranks, so each level counts once at most, the longest first."""
        total = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            rank, far = self.levels[k], 1 << k
            x, y = (a + total, b + total) if step > 0 else (a - total - far, b - total - far)
            inside = (np.maximum(x, y) < self.end[a]) if step > 0 else (np.minimum(x, y) >= self.first[a])
            x, y = (np.clip(z, 0, self.n - 1) for z in (x, y))
            total += np.where(inside & (rank[x] == rank[y]), far, 0)
        return total

    def lcp(self) -> np.ndarray:
        """Common prefix of each suffix and the one before it in the array; -1 between
        texts and at both ends."""
        out = np.full(self.n + 1, -1, dtype=np.int64)
        a, b = self.sa[:-1], self.sa[1:]
        same = np.flatnonzero(self.text[a] == self.text[b])
        out[same + 1] = self.agree(a[same], b[same], 1)
        return out


def _smaller(lcp: np.ndarray, step: int, strictly: bool) -> np.ndarray:
    """For each place of common prefix 1 or more, the next place on the right (``step`` 1)
    or left with a smaller one, or with a smaller or equal one; by pointer jumping.  Ways
    are shortened all at once: what a pointer skips is no less than its own place."""
    at = np.arange(len(lcp)) + step
    at[0], at[-1] = 0, len(lcp) - 1
    todo = np.flatnonzero(lcp > 0)
    while len(todo):
        value, found = lcp[todo], lcp[at[todo]]
        todo = todo[found >= value if strictly else found > value]
        at[todo] = at[at[todo]]
    return at


def branching_squares(s: Suffixes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and root lengths of all squares whose next word differs from the root's
    first, some of them twice."""
    lcp = s.lcp()
    cuts = np.flatnonzero(lcp > 0)
    if not len(cuts):
        return
    depth = lcp[cuts]
    left, right = _smaller(lcp, -1, True)[cuts], _smaller(lcp, 1, True)[cuts]
    near_left, near_right = _smaller(lcp, -1, False)[cuts], _smaller(lcp, 1, False)[cuts]
    # Children: what lies before each cut, back to the one before; and after the last cut.
    last = near_right == right
    begin = np.concatenate([near_left, cuts[last]])
    stop = np.concatenate([cuts, right[last]])
    low, high, depth = (np.concatenate([x, x[last]]) for x in (left, right, depth))
    size = stop - begin
    # The largest child of an interval, which its two ends name, is not looked at.
    order = np.lexsort((begin, size, high, low))
    largest = np.ones(len(order), dtype=bool)
    largest[:-1] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    small = order[~largest]
    begin, size, low, high, depth = (x[small] for x in (begin, size, low, high, depth))
    upto = np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + AT_ONCE, side="right")))
        yield from _tested(s, begin[at:to], size[at:to], low[at:to], high[at:to], depth[at:to])
        at = to


def _tested(s: Suffixes, begin, size, low, high, depth) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ends = np.cumsum(size)
    i = s.sa[np.repeat(begin - ends + size, size) + np.arange(int(ends[-1]))]
    low, high, depth = (np.repeat(x, size) for x in (low, high, depth))
    for sign in (1, -1):
        mate = i + sign * depth
        inside = mate < s.end[i] if sign > 0 else mate >= s.first[i]
        where = s.isa[np.where(inside, mate, i)]
        hit = np.flatnonzero(inside & (low <= where) & (where < high))
        start, root = np.minimum(i, mate)[hit], depth[hit]
        after = start + 2 * root
        cut = after >= s.end[start]
        branching = cut | (s.words[np.where(cut, start, after)] != s.words[start + root])
        yield start[branching], root[branching]


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of the runs of several texts, as places in ``words``,
    ordered by start, then period.  ``periods`` is 2 at least."""
    none = np.zeros(0, dtype=np.int64)
    if not len(words):
        return none, none, none
    s = Suffixes(np.asarray(words, dtype=np.int64), np.asarray(bounds, dtype=np.int64))
    found = list(branching_squares(s))
    if not found:
        return none, none, none
    start, root = (np.concatenate(x) for x in zip(*found, strict=True))
    end = start + 2 * root
    start = start - s.agree(start, start + root, -1)  # rotate to the left
    order = np.lexsort((root, end, start))
    start, end, root = start[order], end[order], root[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    keep = new & (end - start >= np.maximum(least, periods * root))
    start, end, root = start[keep], end[keep], root[keep]
    order = np.lexsort((root, start))
    return start[order], (end - start)[order], root[order]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> DataFrame:
    """``docs`` plus ``runs``, an array of (start, length, period) in words, by start, then
    period; and ``collapsed``, the text without the words that any run contains after its
    first period, its words joined by one space.  Words are what white space of ASCII
    separates."""

    def work(texts: list) -> tuple:
        split = [(t or b"").split() for t in texts]
        bounds = np.cumsum([0, *map(len, split)])
        number: dict[bytes, int] = {}
        words = np.fromiter((number.setdefault(w, len(number)) for ws in split for w in ws), np.int64, int(bounds[-1]))
        start, length, period = find_runs(words, bounds, least, periods)
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        kept = np.cumsum(change[:-1]) == 0
        of = np.searchsorted(bounds, start, side="right") - 1
        upto = np.searchsorted(of, np.arange(len(texts) + 1))
        rows = pa.StructArray.from_arrays([pa.array(x) for x in (start - bounds[of], length, period)], names=["start", "length", "period"])
        collapsed = []
        for k, ws in enumerate(split):
            if upto[k] < upto[k + 1]:
                ws = [w for w, keep in zip(ws, kept[bounds[k] : bounds[k + 1]].tolist(), strict=True) if keep]
            collapsed.append(b" ".join(ws))
        return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), rows), pa.array(collapsed, pa.binary()).cast(pa.string())

    fields = [("runs", "array<struct<start:bigint,length:bigint,period:bigint>>", _RUNS), ("collapsed", "string", pa.string())]
    return add_from_text(docs, fields, lambda: work, text, as_bytes=True, slice_bytes=SLICE)


def greatest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; the first of equal ones."""
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))),
        F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )


def plant(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` whose text is made periodic from some word on, in about one row of ten.

    With h the checksum of the key and g = h // 10: if 10 divides h, each of the n words
    from number a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).
    A null key counts as the empty text."""
    spaces = r"[\x20\x09-\x0D]+"
    body = F.regexp_replace(F.col(text), rf"^{spaces}|{spaces}$", "")
    words = F.when(F.length(body) > 0, F.split(body, spaces)).otherwise(F.array().cast("array<string>"))
    h = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    names = [fresh(docs, n) for n in ("w", "g", "a", "p")]
    w, g, a, p = (F.col(n) for n in names)
    n = F.size(w)
    spots = F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1)
    moved = F.transform(spots, lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    made = docs.withColumn(names[0], F.when(h % 10 == 0, words)).withColumn(names[1], F.floor(h / 10))
    made = made.withColumn(names[2], F.when(n > 0, g % n)).withColumn(names[3], 1 + F.floor((n - a) / (3 + g % 8)))
    return made.withColumn(text, F.when(n > 0, F.array_join(moved, " ")).otherwise(F.col(text))).select(docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """The query's result: digests of the runs and of the collapsed text of each row."""
    found = periodic_runs(plant(docs.select("doc_id", "text")))
    best = greatest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
