import math
from collections import defaultdict

import numpy as np
from logmetrics.llm import embedding_dedup as e

SCHEMA = "vec_id bigint, embedding array<float>, label int, key string, n_links int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "k", 1) for i, v in rows], SCHEMA)


def brute(rows, threshold=0.9):
    units = []
    for _, v in rows:
        ok = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        a = np.array(v, dtype=np.float32).astype(float) if ok else None
        units.append(a / np.linalg.norm(a) if ok else None)
    near = defaultdict(set)
    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= threshold:
                near[i].add(j)
                near[j].add(i)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((vec_id, len(near[i]), min(rows[j][0] for j in seen)))
    return out


def clusters(rng, n, dim, copies, noise):
    rows = []
    for _ in range(n):
        base = rng.standard_normal(dim)
        for _ in range(rng.integers(1, copies)):
            rows.append((len(rows), (base + noise * rng.standard_normal(dim)).astype(np.float32).tolist()))
    return rows


ODD = [(900, None), (901, []), (902, [0.0] * 16), (903, [1.0, None] * 8), (904, [float("nan")] * 16), (905, [float("inf")] * 16), (906, [1e-30] * 16), (907, [3e30] * 16), (908, [1.0, 1.0]), (909, [2.0, 2.0]), (910, [5.0]), (911, [-5.0])]


def test_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = clusters(rng, 60, 16, 8, 0.08) + ODD
    rows += [(950, rows[0][1]), (950, rows[0][1]), (951, rows[3][1])]
    got = [(r.vec_id, r.n_links, r.component_id) for r in e.report(table(spark, rows)).collect()]
    assert sorted(got) == sorted(brute(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in e.report(table(spark, rows)).collect())


def test_large_group_in_blocks(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(32)
    rows = [(i, (base + 0.1 * rng.standard_normal(32)).astype(np.float32).tolist()) for i in range(90)]
    got = [(r.vec_id, r.n_links, r.component_id) for r in e.similar(table(spark, rows), block=16).collect()]
    want = brute(rows)
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))


def test_recall_at_the_threshold():
    """Pairs at exactly 0.9 share a filter nearly always, at any number of vectors."""
    rng = np.random.default_rng(6)
    for n in (1000, 50_000, 2_000_000):
        caps, met = e.Caps(64, n), 0
        x = rng.standard_normal((300, 64))
        x /= np.linalg.norm(x, axis=1)[:, None]
        y = rng.standard_normal((300, 64))
        y -= (x * y).sum(axis=1)[:, None] * x
        y = 0.9 * x + math.sqrt(1 - 0.81) * y / np.linalg.norm(y, axis=1)[:, None]
        for a, b in zip(caps.decode(x), caps.decode(y)):
            met += bool(set(a.tolist()) & set(b.tolist()))
        assert met >= 0.98 * 300, (n, met)


def test_decoding_lists_all_filters():
    caps = e.Caps(10, 100)
    rng = np.random.default_rng(7)
    x = rng.standard_normal((5, 10))
    x /= np.linalg.norm(x, axis=1)[:, None]
    bound = caps.bound * math.sqrt(2)
    for i, got in enumerate(caps.decode(x)):
        want = set()
        for c in range(caps.codes):
            z = x[i] @ caps.turns[c]
            for u, a in enumerate(caps.left[c] @ z[:5]):
                want |= {(c * caps.words + u) * caps.words + v for v, b in enumerate(caps.right[c] @ z[5:]) if a + b >= bound}
        assert set(got.tolist()) == want


def test_empty(spark):
    assert e.report(table(spark, [])).count() == 0
    assert [r.n_links for r in e.report(table(spark, ODD[:3])).collect()] == [0, 0, 0]
