"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

A text's shingles are its runs of ``SHINGLE`` words (lower-cased A-Z; words as in
``decontamination``); a shorter text is one shingle.  Texts with the same words form a
class at once; from here on classes count, weighted by their copies.

A class's signature holds ``DEPTH`` minima of its hashed shingles for each of ``TREES``
trees.  A tree is the sorted list of its signatures, a prefix trie without nodes: classes
that share a prefix stand together, so those next to each other, with the length of the
prefix they share, say for every depth which classes are one subtree.  Matched prefixes
start at full depth and are shortened, one minimum at a time, until the estimated recall
of the pairs that are tied reaches ``RECALL``; at the latest at the depth at which even a
pair of just the threshold is tied with that probability.  Tied classes form candidate
groups, and within a group all pairs are verified exactly on their shingle sets, so pairs
that no tree brought together are found as well.

The estimate: a pair tied at depth d in c of t trees has a similarity of about (c / t) to
the power 1 / d, and pairs of similarity s are tied with p = 1 - (1 - s^d)^t; over tied
pairs of at least the threshold, recall is their number by the sum of 1 / p.

Scale.  Signatures come from one narrow scan.  Each tree is range-partitioned and sorted
once for all depths; neighbours are compared within a partition, and the driver compares
the two ends of each partition.  A prefix that many classes share spans partitions, no
task gathers it.  Texts travel once to be joined with their group, and once per block of
the group's classes to be verified; a group beyond ``BLOCK`` classes is dealt into blocks,
one task per pair of blocks, so no group meets in one task.  Pairs are counted inside the
task: a class and its number of links leave it, not the pairs.

Cases.  Null texts and those without words link with nothing.  Repeated rows, also of
one id, are copies of each other.  Words of a class are compared by a 128-bit checksum,
shingles by a 64-bit one."""

from __future__ import annotations

import hashlib
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_from_text, fresh, store
from .components import components
from .decontamination import words
from .hashing import mix, prefix_sums

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH, RECALL = 24, 8, 0.999
BLOCK = 256
SALTS = 16
#: Columns of one dense multiplication in verification.
_COLUMNS = 4096

#: Bytes of a text that are hashed at once.
_AT_ONCE = 1 << 20


def shingles(plain: bytes, size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the runs of ``size`` words of ``plain``, whose words stand one
    space apart.  A long text goes in parts that share ``size`` - 1 words."""
    out, at = [], 0
    while len(plain) - at > _AT_ONCE:
        cut = back = plain.rfind(b" ", at, at + _AT_ONCE)
        for _ in range(size - 1):
            back = plain.rfind(b" ", at, max(back, at))
        if back <= at:  # words as long as a part
            break
        out.append(_shingles(plain[at:cut], size))
        at = back + 1
    out.append(_shingles(plain[at:], size))
    return np.concatenate(out)


def _shingles(plain: bytes, size: int) -> np.ndarray:
    """A rolling polynomial hash gives every run from two prefix sums."""
    if not plain:
        return np.zeros(0, dtype=np.uint64)
    raw = np.frombuffer(plain, dtype=np.uint8)
    sums, down = prefix_sums(raw)
    gaps = np.flatnonzero(raw == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(raw)]])
    n = max(1, len(starts) - size + 1)
    last = min(size, len(starts)) - 1
    a, b = starts[:n], ends[last : last + n]
    return mix((sums[b] - sums[a]) * down[a])


def tied(similarity, depth: int, trees: int = TREES):
    """Probability that a pair shares a prefix of ``depth`` minima in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def least_depth(trees: int = TREES, depth: int = DEPTH, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Depth at which a pair of just the threshold is tied surely enough."""
    while depth > 1 and tied(threshold, depth, trees) < recall:
        depth -= 1
    return depth


class Forest:
    """Signatures of a class in every tree."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, threshold: float = THRESHOLD, recall: float = RECALL):
        self.trees, self.depth, self.threshold, self.recall = trees, depth, threshold, recall
        self.least = least_depth(trees, depth, threshold, recall)
        rng = np.random.default_rng(44)
        n = trees * depth
        self.a = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 1 << 32, n, dtype=np.uint32)

    def paths(self, hashes: np.ndarray) -> list[bytes]:
        """Per tree, the minima in order as big-endian bytes, which sort as they do."""
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.a), 0xFFFFFFFF, dtype=np.uint32)
        for i in range(0, len(x), 2048):
            h = x[i : i + 2048, None] * self.a
            h += self.b
            np.minimum(least, h.min(axis=0), out=least)
        return [row.tobytes() for row in least.reshape(self.trees, self.depth).astype(">u4")]


def shared_prefix(tree: np.ndarray, path: np.ndarray) -> np.ndarray:
    """Minima that each row of (tree, path) but the first shares with the one before."""
    same = (path[1:] == path[:-1]) & (tree[1:] == tree[:-1])[:, None]
    return np.cumprod(same, axis=1).sum(axis=1)


def neighbours(classes: DataFrame, forest: Forest) -> DataFrame:
    """(a, b, shared): classes (nodes) that stand next to each other in a tree and share
    ``shared`` minima, ``forest.least`` or more; a pair comes once per such tree.  Those
    that share d or more are the edges that tie the subtrees at depth d."""
    depth, least = forest.depth, forest.least
    sorted_paths = classes.select("node", F.posexplode("trees").alias("tree", "path")).repartitionByRange("tree", "path", "node").sortWithinPartitions("tree", "path", "node")

    def numbers(batch):
        path = np.frombuffer(b"".join(batch.column("path").to_pylist()), dtype=">u4").reshape(-1, depth)
        return batch.column("tree").to_numpy(), path, batch.column("node").to_numpy()

    names = ["a", "b", "shared", "tree", "path"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def rows(a, b, shared, tree, path):
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip((a, b, shared, tree, path), kinds, strict=True)], names=names)

    def scan(batches):
        end = None  # last row so far
        for batch in batches:
            if not len(batch):
                continue
            tree, path, node = numbers(batch)
            if end is None:  # the partition's first row, and later its last, go to the driver
                yield rows([node[0]], [None], [None], [tree[0]], [path[0].tobytes()])
            else:
                tree, path, node = np.append(end[0], tree), np.vstack([end[1], path]), np.append(end[2], node)
            shared = shared_prefix(tree, path)
            at = np.flatnonzero(shared >= least)
            nothing = [None] * len(at)
            yield rows(node[at], node[at + 1], shared[at], nothing, nothing)
            end = tree[-1:], path[-1:], node[-1:]
        if end is not None:
            yield rows(end[2], [None], [None], end[0], [end[1][0].tobytes()])

    found = store(sorted_paths.mapInArrow(scan, "a bigint, b bigint, shared int, tree int, path binary"), "neighbours")
    edges = found.where("b is not null").select("a", "b", "shared")
    ends = sorted((r["tree"], bytes(r["path"]), r["a"]) for r in found.where("b is null").collect())  # two rows per partition
    if len(ends) > 1:
        tree = np.array([t for t, _, _ in ends])
        path = np.frombuffer(b"".join(p for _, p, _ in ends), dtype=">u4").reshape(-1, depth)
        shared = shared_prefix(tree, path)
        across = [(ends[i][2], ends[i + 1][2], int(shared[i])) for i in np.flatnonzero(shared >= least).tolist()]
        edges = edges.union(classes.sparkSession.createDataFrame(across, "a bigint, b bigint, shared int"))
    return edges.where("a <> b")


def matched_depth(edges: DataFrame, forest: Forest) -> int:
    """Shorten the matched prefix until the tied pairs' estimated recall is reached."""
    pairs = edges.groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
    depths = range(forest.least, forest.depth + 1)
    counts = pairs.agg(*[F.count_if(F.col("shared") >= d).alias(f"c{d}") for d in depths])
    sums = []
    for d in depths:
        share = F.least(F.col(f"c{d}") / forest.trees, F.lit(1.0))
        alike = F.pow(share, F.lit(1.0 / d)) >= forest.threshold
        sums += [F.count_if(alike).alias(f"n{d}"), F.sum(F.when(alike, 1 / (1 - F.pow(1 - share, F.lit(forest.trees))))).alias(f"s{d}")]
    got = counts.agg(*sums).first()
    for d in reversed(depths):
        if got[f"n{d}"] and got[f"n{d}"] >= forest.recall * got[f"s{d}"]:
            return d
    return forest.least


def _plain(text: bytes | None) -> bytes:
    return b" ".join(words(text))


def signatures(docs: DataFrame, text: str, forest: Forest | None, size: int, into: tuple[str, str] = ("key", "trees")) -> DataFrame:
    """All columns of ``docs`` plus the class checksum (null without words) and, with a
    forest, the signature."""

    def make():
        def work(texts):
            keys, trees = [], []
            for t in texts:
                plain = _plain(t)
                keys.append(hashlib.md5(plain, usedforsecurity=False).digest() if plain else None)
                if forest:
                    trees.append(forest.paths(shingles(plain, size)) if plain else None)
            return [keys, trees] if forest else [keys]

        return work

    fields = [(into[0], "binary", pa.binary())]
    if forest:
        fields.append((into[1], "array<binary>", pa.list_(pa.binary())))
    return add_from_text(docs, fields, make, text, as_bytes=True)


def overlaps(sets: list[np.ndarray], split: int) -> np.ndarray:
    """Sizes of the intersections of the first ``split`` sets with the others (with
    themselves if ``split`` is their number), by dense products over shared elements."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[col]
    owner, col = owner[keep], number[col[keep]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    rest = slice(split, None) if split < len(sets) else slice(None)
    out = np.zeros((split, len(sets) - split if split < len(sets) else split), dtype=np.float64)
    n = int(shared.sum())
    for at in range(0, n, _COLUMNS):
        a, b = np.searchsorted(col, [at, at + _COLUMNS])
        dense = np.zeros((len(sets), min(_COLUMNS, n - at)), dtype=np.float32)
        dense[owner[a:b], col[a:b] - at] = 1
        out += dense[:split] @ dense[rest].T
    return out


def _links(sets: list[np.ndarray], split: int, threshold: float) -> np.ndarray:
    """(i, j) of pairs at or above the threshold, i from the first ``split`` sets."""
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    both = overlaps(sets, split)
    other = sizes[split:] if split < len(sets) else sizes
    near = both / (sizes[:split, None] + other[None, :] - both) >= threshold
    if split == len(sets):
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    return np.stack([i, j + (split if split < len(sets) else 0)], axis=1)


def _roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """Least linked index of each index, by rounds of minima."""
    root = np.arange(n)
    while len(pairs):
        least = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        new = root.copy()
        np.minimum.at(new, pairs[:, 0], least)
        np.minimum.at(new, pairs[:, 1], least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _verify(rows: pd.DataFrame, size: int, threshold: float) -> pd.DataFrame:
    """Links within one unit: blocks (i, j) of a candidate group, or whole small groups."""
    out = []
    for (_, i, j), unit in rows.groupby(["grp", "i", "j"], sort=False):
        unit = unit.drop_duplicates("key").sort_values(["block", "key"], kind="stable")
        split = len(unit) if i == j else int((unit["block"] == i).sum())
        if split == 0 or len(unit) < 2 or (i != j and split == len(unit)):
            continue
        sets = [np.unique(shingles(_plain(t), size)) for t in unit["text"]]
        pairs = _links(sets, split, threshold)
        if not len(pairs):
            continue
        copies = unit["copies"].to_numpy()
        got = np.zeros(len(unit), dtype=np.int64)
        np.add.at(got, pairs[:, 0], copies[pairs[:, 1]])
        np.add.at(got, pairs[:, 1], copies[pairs[:, 0]])
        keys = unit["key"].to_numpy()
        at = np.flatnonzero(got)
        whole = bool((unit["blocks"] == 1).all())
        out.append(pd.DataFrame({"key": keys[at], "n": got[at], "root": keys[_roots(len(unit), pairs)[at]], "whole": whole}))
    return pd.concat(out) if out else pd.DataFrame({"key": [], "n": np.zeros(0, dtype=np.int64), "root": [], "whole": np.zeros(0, dtype=bool)})


def similar_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE, threshold: float = THRESHOLD, forest: Forest | None = None, block: int = BLOCK):
    """(rows, classes): ``rows`` (doc_id, key); ``classes`` (key, least_id, copies,
    n_links, group_id, first) of every class with copies or links, where ``n_links`` counts
    the other rows linked with a row of the class, ``group_id`` is the least id that
    links reach, and ``first`` is the key of a class with that id.  Ids may be null or
    repeated, so only ``first`` names a group surely."""
    forest = forest or Forest(threshold=threshold)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = store(signatures(docs, "text", forest, size).select("doc_id", "key", "trees"), "signatures")
    classes = store(
        rows.where("key is not null")
        .groupBy("key")
        .agg(F.min("doc_id").alias("least_id"), F.count("*").alias("copies"), F.first("trees").alias("trees"))
        .withColumn("node", F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long")),
        "classes",
    )
    # The forest: members of a subtree at the matched depth are tied to its least member,
    # which is mostly the same in all trees.
    depth = matched_depth(neighbours(classes, forest), forest)
    prefix = F.xxhash64("tree", F.substring("path", 1, 4 * depth))
    labels = classes.select("node", F.posexplode("trees").alias("tree", "path")).select("node", prefix.alias("label"))
    subtrees = labels.groupBy("label").agg(F.min("node").alias("root"), F.max("node").alias("top")).where("root < top").select("label", "root")
    ties = labels.join(subtrees, "label").where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    groups = components(ties).withColumnRenamed("component", "grp")
    sizes = groups.groupBy("grp").agg(F.count("*").alias("members"))
    members = store(groups.join(sizes, "grp").join(classes.drop("trees"), "node").select("key", "least_id", "copies", "grp", "members"), "members")
    # Verification units: pairs of blocks of large groups, small groups bundled.
    n_bundles = max(1, -(-members.count() // block))
    blocks = F.ceil(F.col("members") / block).cast("int")
    own = F.when(F.col("members") <= block, F.lit(0)).otherwise(F.pmod(F.hash("key"), blocks))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    # One text of each class, by its checksum; its least id, too, so that copies of a common
    # text don't meet.  Rows alike in both are thinned only if there are any.
    least = F.col("doc_id").eqNullSafe(F.col("least_id")) & (F.col("key") == F.col("mark"))
    marked = members.withColumnRenamed("key", "mark")
    texts = signatures(docs, "text", None, size, into=("key", "")).join(marked.hint("merge"), least).drop("mark")
    if not rows.join(marked, least).groupBy("mark").count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["key"])
    units = (
        texts.withColumn("blocks", F.greatest(F.lit(1), blocks))
        .withColumn("block", own)
        .withColumn("pair", F.explode(pairs))
        .select("key", "copies", "grp", "block", "blocks", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), F.col("text").cast("binary").alias("text"), "members")
        .withColumn("unit", F.when(F.col("members") <= block, F.pmod(F.xxhash64("grp"), F.lit(n_bundles))).otherwise(F.xxhash64("grp", "i", "j")))
        .drop("members")
    )

    def verify(unit: tuple[Any, ...], part: pd.DataFrame) -> pd.DataFrame:
        return _verify(part, size, threshold)

    found = store(units.groupBy("unit").applyInPandas(verify, "key binary, n bigint, root binary, whole boolean"), "links")
    linked = found.groupBy("key").agg(F.sum("n").alias("links"), F.min("root").alias("root"))
    known = classes.drop("trees", "node").join(linked, "key", "left").where("copies > 1 or links is not null")
    # A unit that is a whole group names its components; blocks have to be tied first.
    parts = found.where("not whole").select(F.col("key").alias("a"), F.col("root").alias("b"))
    if parts.isEmpty():
        known = known.withColumn("component", F.coalesce("root", "key"))
    else:
        joined = components(parts).withColumnRenamed("node", "key")
        known = known.join(joined, "key", "left").withColumn("component", F.coalesce("component", "root", "key"))
    known = store(known, "known")
    first = F.min(F.struct(F.col("least_id").isNull().alias("none"), "least_id", "key")).alias("first")
    firsts = known.groupBy("component").agg(first).select("component", F.col("first.least_id").alias("group_id"), F.col("first.key").alias("first"))
    links = F.col("copies") - 1 + F.coalesce("links", F.lit(0))
    # A component with most of the classes is dealt over salts of this join.
    salted = firsts.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    known = known.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    out = known.join(salted, ["component", "salt"]).select("key", "least_id", "copies", links.alias("n_links"), "group_id", "first")
    return rows.select("doc_id", "key"), store(out, "similar")


def similar(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (least id with the same words),
    n_links (other rows at or above the threshold), group_id (least id that links reach)
    and kept (whether this id stays for its group)."""
    rows, classes = similar_classes(docs, text, doc_id, **how)
    out = rows.join(classes, "key", "left")
    group = F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("group_id"))
    return out.select(
        "doc_id",
        F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("least_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        group.alias("group_id"),
        group.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """``docs`` with one row of each group of similar texts: that with the least id, of
    the least class if several have it.  All rows without words stay."""
    members, classes = similar_classes(docs, text, doc_id, **how)
    key, mark = fresh(docs, "key"), fresh(docs, "mark")
    stay = classes.select(F.col("key").alias(mark), F.col("least_id").alias(f"{mark}least"), F.col("first").alias(f"{mark}first"))
    rows = signatures(docs, text, None, 0, into=(key, ""))
    # Rows without words get a key of their own, so they meet nothing and no hot key.
    rows = rows.withColumn(key, F.coalesce(F.col(key), F.concat(F.lit(b"\x00"), F.unhex(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))))))
    joined = rows.join(stay.hint("merge"), F.col(key) == F.col(mark), "left")
    chosen = (F.col(mark) == F.col(f"{mark}first")) & F.col(doc_id).eqNullSafe(F.col(f"{mark}least"))
    kept = joined.where(F.col(mark).isNull() | chosen)
    # Several rows of that class may share its least id; only then is a further step needed.
    first = members.join(classes, "key").where((F.col("key") == F.col("first")) & F.col("doc_id").eqNullSafe(F.col("least_id")))
    if not first.groupBy("key").count().where("count > 1").isEmpty():
        alone = kept.where(F.col(mark).isNull())
        kept = alone.unionByName(kept.where(F.col(mark).isNotNull()).dropDuplicates([mark]))
    return kept.select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """The query's result: class, number of links and group of every document."""
    return similar(docs.select("doc_id", "text"))
