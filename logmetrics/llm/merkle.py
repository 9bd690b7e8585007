"""Merkle manifest of a dataset: a proof for every row, checked by folding it.

Every row becomes a leaf, the SHA-256 of its fields.  The leaves of a group (a source), by
key, are the lowest nodes of a tree in which every three consecutive nodes become their
digest, up to the group's subroot; subroots, by group, become the root in the same way.
A row's proof is the list of siblings on its way to the root.

Trees are cut into superblocks of ``BLOCK`` = 3^7 consecutive nodes, each a whole subtree.
Upwards, a superblock becomes one node of the next level, until each group has one, and
the subroots likewise until there is one.  Downwards, the nodes of a superblock and the
one outer row it needs (the proof of the superblock itself) are cogrouped, and one
``applyInPandas`` call finishes the local reduction, joins the local proof to the outer
one and, at the leaves, folds every claimed leaf with its siblings up to a root.

Scale.  Texts are hashed in one narrow scan and never shuffled; what moves are digests.
Positions come from one range sort: a row's place in its partition, plus what the
partitions before it hold (a broadcast of one row per partition), less where its group
begins.  Groups are never gathered: a group of any size is split into superblocks, which
are the unit of every shuffle, so no task holds more than its superblocks.  The number
of levels is the logarithm of the largest group to the base 2187.  Levels are stored, so
a lost executor repeats one level at most.

Cases.  A null field is ``-``.  Null keys and null groups come first, rows of equal keys by
their leaf; equal rows are leaves of their own.  A lone leaf is its group's subroot, a lone
subroot the root.  An empty table gives no rows and no root."""

from __future__ import annotations

from hashlib import sha256
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, store

ARITY, HEIGHT = 3, 7
BLOCK = ARITY**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_IN_PARTITION = 33  # bits of a row's place in monotonically_increasing_id


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the count of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def reduction(nodes: list[str], n: int, height: int = HEIGHT) -> list[list[str]]:
    """The levels above ``nodes`` within their superblock, themselves included; ``n`` counts
    their whole tree level.  If it goes beyond the superblock, all local levels are built,
    even over one node; else as many as leave one node."""
    levels = [nodes]
    while len(levels) <= height and (n > ARITY**height or len(levels[-1]) > 1):
        low = levels[-1]
        levels.append([digest("".join(low[i : i + ARITY])) for i in range(0, len(low), ARITY)])
    return levels


def siblings(levels: list[list[str]]) -> tuple[list[list[str]], list[list[str]]]:
    """For each lowest node, level by level, the joined siblings to its left and right."""
    left, right = [], []
    for nodes in levels[:-1]:
        at = [i - i % ARITY for i in range(len(nodes))]
        left.append(["".join(nodes[a:i]) for i, a in enumerate(at)])
        right.append(["".join(nodes[i + 1 : a + ARITY]) for i, a in enumerate(at)])
    return tuple([[side[t][i // ARITY**t] for t in range(len(side))] for i in range(len(levels[0]))] for side in (left, right))


def fold(claim: str, left: list[str], right: list[str]) -> str:
    """The root that a leaf and the siblings on its way lead to."""
    for a, b in zip(left, right, strict=True):
        claim = digest(a + claim + b)
    return claim


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` plus ``at``, its place in the whole order from 0, and ``part``, the sorted
    partition it lies in.  The order must be total but for rows that are alike."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = store(placed, name).withColumn("part", F.shiftright("at", _IN_PARTITION))
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = placed.groupBy("part").count().select("part", before.alias("offset"))  # a row per partition
    at = F.col("at") - F.shiftleft("part", _IN_PARTITION) + F.col("offset")
    return placed.join(F.broadcast(offsets), "part").withColumn("at", at).drop("offset")


def positions(leaves: DataFrame) -> DataFrame:
    """``leaves`` (group, key, leaf, tie) plus ``g``, the number of its group, ``pos``, its
    place there, and ``n``, the group's size."""
    rows = numbered(leaves, ["group", "key", "leaf", "tie"], "merkle-order")
    # A group's part in a partition: at most a row per partition and one per group.
    parts = store(rows.groupBy("group", "part").agg(F.min("at").alias("low"), F.count("*").alias("c")), "merkle-parts")
    groups = numbered(parts.groupBy("group").agg(F.min("low").alias("low"), F.sum("c").alias("n")), ["group"], "merkle-groups")
    groups = groups.select(F.col("group").alias("of"), F.col("at").alias("g"), F.col("low").alias("begin"), "n")
    where = parts.join(groups, F.col("group").eqNullSafe(F.col("of"))).select("of", F.col("part").alias("in"), "g", "begin", "n")
    # The join's key has the partition in it, so a hot group is dealt over its partitions.
    found = rows.join(where, F.col("group").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
    return found.withColumn("pos", F.col("at") - F.col("begin")).drop("of", "in", "begin", "at", "part", "tie")


def _block(height: int) -> Column:
    return F.floor(F.col("pos") / ARITY**height).cast("bigint").alias("block")


def _up(nodes: DataFrame, height: int, name: str) -> list[DataFrame]:
    """Levels of superblocks above ``nodes`` (g, pos, n, digest), these first, until each
    group has one node."""

    def reduce(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].iloc[0])
        top = reduction(rows.sort_values("pos")["digest"].tolist(), n, height)[-1][0]
        return pd.DataFrame({"g": [key[0]], "pos": [key[1]], "n": [-(-n // ARITY**height)], "digest": [top]})

    levels = [nodes]
    while not levels[-1].where("n > 1").isEmpty():
        low = levels[-1].select("g", "pos", "n", "digest")
        levels.append(store(low.groupBy("g", _block(height)).applyInPandas(reduce, "g bigint, pos bigint, n bigint, digest string"), name))
    return levels


_WAY = "`left` array<string>, `right` array<string>, subroot string, root string"


def _down(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """``outer`` has the proof of each superblock (g, pos, left, right, subroot, root); the
    result that of each of the ``nodes``, and for nodes with a ``claim`` its folded root."""
    kept = [f for f in nodes.schema.fields if f.name not in ("left", "right", "subroot", "root")]
    claims = "claim" in nodes.columns

    def finish(key: tuple[Any, ...], rows: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos").drop(columns="block").reset_index(drop=True)
        levels = reduction(rows["digest"].tolist(), int(rows["n"].iloc[0]), height)
        far = outside.iloc[0]
        far_left, far_right = list(far["left"]), list(far["right"])
        near_left, near_right = siblings(levels)
        rows["left"] = [near + far_left for near in near_left]
        rows["right"] = [near + far_right for near in near_right]
        rows["subroot"], rows["root"] = far["subroot"], far["root"]
        if claims:
            rows["folded"] = [fold(*way) for way in zip(rows["claim"], rows["left"], rows["right"], strict=True)]
        return rows

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", {_WAY}" + (", folded string" if claims else "")
    inner = nodes.withColumn("block", _block(height))
    return inner.groupBy("g", "block").cogroup(outer.groupBy("g", "pos")).applyInPandas(finish, schema)


def prove(leaves: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``leaves`` has ``key``, ``group``, ``leaf`` and ``claim``: the leaf that is to be
    verified.  The result adds ``subroot``, ``root``, the proof as arrays ``left`` and
    ``right`` (joined siblings of each level, leaf first) and ``folded``, the root that the
    claim leads to.  Keys are sorted by their own type and travel as text."""
    ship(leaves.sparkSession)
    kind = leaves.schema["key"].dataType
    rows = store(leaves.select("key", "group", "leaf", "claim", F.monotonically_increasing_id().alias("tie")), "merkle-leaves")
    placed = positions(rows).select(F.col("key").cast("string").alias("key"), "group", "g", "pos", "n", F.col("leaf").alias("digest"), "claim")
    lowest = store(placed, "merkle-placed")
    inside = _up(lowest, height, "merkle-level")
    zero, n_groups = F.lit(0).cast("bigint"), F.lit(inside[-1].count()).cast("bigint")
    above = _up(inside[-1].select(zero.alias("g"), F.col("g").alias("pos"), n_groups.alias("n"), "digest"), height, "merkle-top")
    none = F.array().cast("array<string>")
    way = above[-1].select("g", "pos", none.alias("left"), none.alias("right"), "digest", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    for nodes in reversed(above[:-1]):
        way = store(_down(nodes, way, height), "merkle-way")
    way = way.select(F.col("pos").alias("g"), zero.alias("pos"), "left", "right", F.col("digest").alias("subroot"), "root")
    for nodes in reversed(inside[1:-1]):
        way = store(_down(nodes, way, height), "merkle-way")
    return _down(lowest, way, height).select(F.col("key").cast(kind).alias("key"), "group", F.col("digest").alias("leaf"), "claim", "subroot", "root", "left", "right", "folded")


def proof(left: str = "left", right: str = "right") -> Column:
    """All siblings of a proof as one text, level by level, left to right."""
    return F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), "")


def tampered(docs: DataFrame) -> Column:
    """The text without line feeds, in rows whose key's checksum is even; a null key counts
    as the empty text."""
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def report(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The query's result: every row's proof, and what the tampered row folds to."""
    own = [F.col(c) for c in FIELDS]
    claim = leaf(*own[:-1], tampered(docs))
    proved = prove(docs.select(F.col("doc_id").alias("key"), F.col("source").alias("group"), leaf(*own).alias("leaf"), claim.alias("claim")), height)
    return proved.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(proof(), 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
