"""Embedding near-duplicates by spherical-cap filters.

A filter is a direction on the sphere; a vector belongs to it if their inner product
exceeds a bound, that is, if it lies in a cap around it.  Directions form structured
random product codes: each of ``CODES`` codes turns the space at random, cuts it in two
halves and has signed orthonormal columns of random turns as code words of either half; a
direction is a pair of code words.  List decoding keeps the words of either half that
could exceed the bound with the other half's best, and tries the pairs of those.  Vectors that share a filter are
compared, and pairs of cosine ``THRESHOLD`` or more, in double precision, are links.

The bound follows from the number of vectors, so that a filter has about ``MEMBERS`` of
them at any size; the number of filters per vector is then set so that a pair at the
threshold shares ``SHARED`` of them on average.

Scale.  Equal vectors form a class first, so copies never meet.  Classes are dealt to
their filters; a filter beyond ``BLOCK`` classes is cut into blocks, one task per pair of
blocks, and small filters are bundled.  A pair that shares several filters counts in the
least of them only, which each task sees from the filters the vectors carry, so counts
leave the task, not pairs.

Cases.  Vectors that are null, empty, zero, or hold null or non-finite components link
with nothing; so do vectors of different lengths with each other.  Repeated rows are
copies and link with each other."""

from __future__ import annotations

import hashlib
import math
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, store
from .components import components
from .ngram_join import _roots

THRESHOLD = 0.9
MEMBERS = 32
SHARED = 14.0
CODES = 8
BLOCK = 512


def _tail(dim: int, at: np.ndarray) -> np.ndarray:
    """P(one coordinate of a random direction >= ``at``), by the density
    (1 - s^2)^((dim - 3) / 2) on a fine grid."""
    s = np.linspace(-1, 1, 200_001)
    mid = (s[1:] + s[:-1]) / 2
    upto = np.concatenate([[0.0], np.cumsum((1 - mid * mid) ** ((dim - 3) / 2))])
    return 1 - np.interp(at, s, upto / upto[-1])


def cap_bound(dim: int, share: float) -> float:
    """Inner product that a share of all directions exceeds."""
    s = np.linspace(-1, 1, 200_001)
    return float(np.interp(-share, -_tail(dim, s), s))


def share_of_partners(dim: int, bound: float, cosine: float) -> float:
    """P(a vector at this cosine is in a cap | the other one is)."""
    s = np.linspace(bound, 1, 4001)[:-1]
    weight = (1 - s * s) ** ((dim - 3) / 2)
    need = (bound - cosine * s) / np.sqrt((1 - cosine * cosine) * (1 - s * s))
    return float((weight * _tail(dim - 1, np.clip(need, -1, 1))).sum() / weight.sum())


class Caps:
    """Filters for ``dim`` dimensions and about ``n`` vectors."""

    def __init__(self, dim: int, n: int, threshold: float = THRESHOLD, members: float = MEMBERS, shared: float = SHARED, codes: int = CODES, seed: int = 6):
        self.dim, self.codes = dim, codes
        share = min(0.02, members / max(n, 1))
        like = max(dim, 4)  # fewer dimensions have no such density; theirs is rougher
        self.bound = cap_bound(like, share)
        per_vector = shared / share_of_partners(like, self.bound, threshold)
        self.half = max(1, dim // 2)
        self.words = max(2, math.ceil(math.sqrt(per_vector / codes / share)))
        rng = np.random.default_rng([seed, dim])
        self.turns, self.left, self.right = [], [], []
        for _ in range(codes):
            self.turns.append(self._orthogonal(rng, dim))
            self.left.append(self._code(rng, self.half))
            self.right.append(self._code(rng, dim - self.half))

    @staticmethod
    def _orthogonal(rng, n: int) -> np.ndarray:
        q, r = np.linalg.qr(rng.standard_normal((n, n)))
        return q * np.sign(np.diag(r))

    def _code(self, rng, n: int) -> np.ndarray:
        if n == 0:
            return np.zeros((self.words, 0))
        turns = [self._orthogonal(rng, n) for _ in range(-(-self.words // (2 * n)))]
        return np.concatenate([np.concatenate([q, -q]) for q in turns])[: self.words]

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Sorted filter numbers of each unit vector (rows)."""
        found = [[] for _ in unit]
        bound = self.bound * math.sqrt(2)  # a direction is (u, v) / sqrt(2)
        for c in range(self.codes):
            x = unit @ self.turns[c]
            a, b = x[:, : self.half] @ self.left[c].T, x[:, self.half :] @ self.right[c].T
            most_a, most_b = a.max(axis=1, initial=0), b.max(axis=1, initial=0)
            for i in range(len(unit)):
                us, vs = np.flatnonzero(a[i] >= bound - most_b[i]), np.flatnonzero(b[i] >= bound - most_a[i])
                if len(us) and len(vs):
                    p, q = np.nonzero(a[i, us][:, None] + b[i, vs] >= bound)
                    found[i].append((c * self.words + us[p]) * self.words + vs[q])
        return [np.sort(np.concatenate(f)).astype(np.int64) if f else np.zeros(0, dtype=np.int64) for f in found]


def _unit(vector) -> np.ndarray | None:
    """The vector in double precision at length one, or None if it links with nothing."""
    if vector is None or len(vector) == 0:
        return None
    v = np.array([math.nan if x is None else x for x in vector], dtype=np.float64)
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if top == 0:
        return None
    v = v / top  # keeps the square from overflow or underflow
    return v / math.sqrt(float(v @ v))


def filtered(rows: DataFrame, n: int, threshold: float) -> DataFrame:
    """``rows`` (id, vector) to (id, key, unit, filters); key is null for vectors that
    link with nothing."""
    ship(rows.sparkSession)
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL("key binary, unit array<double>, filters array<bigint>").fields])
    kinds = [pa.binary(), pa.list_(pa.float64()), pa.list_(pa.int64())]

    def scan(batches):
        caps: dict[int, Caps] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                units = [_unit(v) for v in batch.column(1).to_pylist()]
                filters: list = [None] * len(units)
                for dim in {len(u) for u in units if u is not None}:
                    if dim not in caps:
                        caps[dim] = Caps(dim, n, threshold)
                    of = [i for i, u in enumerate(units) if u is not None and len(u) == dim]
                    for i, f in zip(of, caps[dim].decode(np.stack([units[i] for i in of])), strict=True):
                        filters[i] = f * 64 + dim % 64  # filters of other lengths stay apart
                keys = [None if u is None else hashlib.md5(u.tobytes(), usedforsecurity=False).digest() for u in units]
                new = [pa.array(v, type=k) for v, k in zip((keys, units, filters), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *new], names=schema.names)

    return rows.mapInArrow(scan, schema)


def _shared_before(filters: list[np.ndarray], now: int) -> np.ndarray:
    """Whether two of the vectors share a filter below ``now``."""
    owner = np.repeat(np.arange(len(filters)), [len(f) for f in filters])
    flat = np.concatenate(filters)
    below = flat < now
    owner, flat = owner[below], flat[below]
    _, col, count = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    keep = (count > 1)[col]
    dense = np.zeros((len(filters), int((count > 1).sum())), dtype=np.float32)
    dense[owner[keep], number[col[keep]]] = 1
    return dense @ dense.T > 0


def _verify(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    out = []
    for (now, i, j), unit in rows.groupby(["filter", "i", "j"], sort=False):
        if len(unit) < 2:
            continue
        vectors = unit["unit"].tolist()
        if len({len(v) for v in vectors}) > 1:  # lengths that share a remainder
            parts = [p for _, p in unit.groupby(unit["unit"].map(len))]
        else:
            parts = [unit]
        for part in parts:
            v = np.stack(part["unit"].tolist())
            near = np.triu(v @ v.T >= threshold, 1)
            block = part["block"].to_numpy()
            if i != j:
                near &= block[:, None] != block[None, :]
            at = np.flatnonzero(near.any(axis=0) | near.any(axis=1))
            if not len(at):
                continue
            near = near[np.ix_(at, at)] & ~_shared_before([part["filters"].iloc[k] for k in at], now)
            pairs = np.argwhere(near)
            if not len(pairs):
                continue
            copies, keys = part["copies"].to_numpy()[at], part["key"].to_numpy()[at]
            got = np.zeros(len(at), dtype=np.int64)
            np.add.at(got, pairs[:, 0], copies[pairs[:, 1]])
            np.add.at(got, pairs[:, 1], copies[pairs[:, 0]])
            some = np.flatnonzero(got)
            out.append(pd.DataFrame({"key": keys[some], "n": got[some], "root": keys[_roots(len(at), pairs)[some]]}))
    return pd.concat(out) if out else pd.DataFrame({"key": [], "n": np.zeros(0, dtype=np.int64), "root": []})


def similar(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept."""
    rows = embeddings.select(F.col(vec_id).alias("id"), F.col(vector).alias("vector"))
    rows = store(filtered(rows, rows.count(), threshold), "filtered")
    classes = store(
        rows.where("key is not null").groupBy("key").agg(F.min("id").alias("least_id"), F.count("*").alias("copies"), F.first("unit").alias("unit"), F.first("filters").alias("filters")), "classes"
    )
    caps = classes.select(F.explode("filters").alias("filter")).groupBy("filter").agg(F.count("*").alias("members")).where("members > 1")
    n_bundles = max(1, -(-(caps.agg(F.sum("members")).first()[0] or 0) // (4 * block)))
    blocks = F.ceil(F.col("members") / block).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    # Which filters matter is worked out on keys alone; vectors then travel once.
    shared = classes.select("key", F.explode("filters").alias("filter")).join(caps, "filter").groupBy("key").agg(F.collect_list(F.struct("filter", "members")).alias("shared"))
    units = (
        classes.join(shared, "key")
        .select("key", "copies", "unit", "filters", F.inline("shared"))
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.hash("key"), F.col("blocks")))
        .withColumn("pair", F.explode(pairs))
        .withColumn("task", F.when(F.col("members") <= block, F.pmod(F.xxhash64("filter"), F.lit(n_bundles))).otherwise(F.xxhash64("filter", "pair.i", "pair.j")))
        .select("task", "filter", "key", "copies", "unit", "filters", "block", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"))
    )

    def verify(task: tuple[Any, ...], part: pd.DataFrame) -> pd.DataFrame:
        return _verify(part, threshold)

    found = store(units.groupBy("task").applyInPandas(verify, "key binary, n bigint, root binary"), "links")
    linked = found.groupBy("key").agg(F.sum("n").alias("links"))
    joined = components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "key")
    known = classes.select("key", "least_id", "copies").join(linked, "key", "left").join(joined, "key", "left").where("copies > 1 or links is not null")
    known = store(known.withColumn("component", F.coalesce("component", "key")), "known")
    least = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = known.join(least, "component").select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "component_id")
    out = rows.select("id", "key").join(known, "key", "left")
    component = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(vec_id), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept")
    )


def report(embeddings: DataFrame) -> DataFrame:
    """The query's result: links and component of every vector."""
    return similar(embeddings.select("vec_id", "embedding"))
