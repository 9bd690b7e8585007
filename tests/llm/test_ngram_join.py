import random
import re
from collections import defaultdict

import numpy as np
from llm.helpers import EDGE, docs_of, empty_docs

from logmetrics.llm import ngram_join as n


def words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def shingle_set(t):
    w = words(t)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, threshold=0.8):
    """(links, group) per row position, over all pairs of rows."""
    sets = [shingle_set(t) for _, t in rows]
    links, near = [0] * len(rows), defaultdict(set)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / len(sets[i] | sets[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                near[i].add(j)
                near[j].add(i)
    group = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        group.append(min(ids) if ids else None)
    return links, group


def corpus(seed=1):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    rows = []
    for base in range(25):
        text = [r.choice(vocab) for _ in range(r.randint(3, 160))]
        rows.append((len(rows), " ".join(text)))
        for _ in range(r.randint(0, 5)):
            copy = list(text)
            for _ in range(r.randint(0, max(1, len(copy) // 40))):
                copy[r.randrange(len(copy))] = r.choice(vocab)
            rows.append((len(rows), " ".join(copy).title() + r.choice(["", ".", " !"])))
    return rows


def got(df):
    return sorted(((r.doc_id, r.n_links, r.group_id) for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    rows = [*corpus(), *((None if i is None else 1000 + i, t) for i, t in EDGE), (2000, "one two three"), (2001, "One, two three!"), (2002, "one two")]
    links, group = brute(rows)
    want = sorted(((rows[i][0], links[i], group[i]) for i in range(len(rows))), key=str)
    assert got(n.report(docs_of(spark, rows))) == want


def test_one_large_group_in_blocks(spark):
    r = random.Random(2)
    text = [f"v{i}" for i in range(300)]
    rows = []
    for i in range(60):
        copy = list(text)
        copy[r.randrange(300)] = f"x{i % 40}"
        rows.append((i, " ".join(copy)))
    links, group = brute(rows)
    want = sorted(((i, links[i], group[i]) for i in range(60)), key=str)
    assert got(n.similar(docs_of(spark, rows).select("doc_id", "text"), block=8)) == want


def test_one_of_each(spark):
    rows = [(5, "a b c d e f g"), (3, "A b c d e f g"), (9, "z y x w v u t"), (3, "a b c d e f g"), (None, "a b c d e f g"), *((100 + (i or 50), t) for i, t in EDGE)]
    out = n.one_of_each(docs_of(spark, rows))
    assert out.columns == docs_of(spark, []).columns
    kept = sorted(r.doc_id for r in out.collect())
    assert kept == [3, 9, 101, 102, 103, 104, 105, 106, 150]
    again = n.one_of_each(out)
    assert sorted(r.doc_id for r in again.collect()) == kept


def test_one_of_each_group_with_null_or_shared_ids(spark):
    """Every group keeps one row, also where ids are null or two groups have the same."""
    text = {g: " ".join(f"{g}{i}" for i in range(60)) for g in "abcde"}
    near = {g: t + " end" for g, t in text.items()}
    rows = [(None, text["a"]), (None, near["a"]), (None, text["b"]), (None, text["b"]), (7, text["c"]), (8, near["c"]), (7, text["d"]), (7, text["d"]), (7, near["e"]), (7, text["e"])]
    out = sorted((r.text[0], r.doc_id) for r in n.one_of_each(docs_of(spark, rows)).collect())
    assert out == [("a", None), ("b", None), ("c", 7), ("d", 7), ("e", 7)]
    links, group = brute(rows)
    want = sorted(((rows[i][0], links[i], group[i]) for i in range(len(rows))), key=str)
    assert got(n.report(docs_of(spark, rows))) == want


def test_depth_and_recall():
    assert n.tied(0.8, n.least_depth()) >= n.RECALL > n.tied(0.8, n.least_depth() + 1)
    f, rng = n.Forest(), np.random.default_rng(3)
    met = 0
    for _ in range(200):
        x = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
        a, b = f.paths(n.mix(x[:810])), f.paths(n.mix(x[90:]))  # similarity 720/900
        met += any(p[: 4 * f.least] == q[: 4 * f.least] for p, q in zip(a, b))
    assert met >= 198


def test_neighbours_tie_what_shares_a_prefix(spark):
    """Components of the neighbours at each depth equal grouping by prefix, also where a
    subtree spans partitions."""
    f, rng = n.Forest(trees=3, depth=5, recall=0.4), np.random.default_rng(4)
    f.least = 1
    paths = [[b"".join(int(v).to_bytes(4, "big") for v in rng.integers(0, 2, 5)) for _ in range(3)] for _ in range(150)]
    classes = spark.createDataFrame(list(enumerate(paths)), "node bigint, trees array<binary>")
    edges = [tuple(r) for r in n.neighbours(classes, f).collect()]
    for d in range(1, 6):
        for tree in range(3):
            assert len({p[tree][: 4 * d] for p in paths}) <= 2**d
        want, have = list(range(150)), list(range(150))

        def join(root, a, b):
            a, b = root[a], root[b]
            return [min(a, b) if r in (a, b) else r for r in root]

        for tree in range(3):
            first = {}
            for i, p in enumerate(paths):
                want = join(want, i, first.setdefault(p[tree][: 4 * d], i))
        for a, b, shared in edges:
            if shared >= d:
                have = join(have, a, b)
        assert have == want


def test_prefixes_are_shortened_until_the_recall(spark):
    f = n.Forest()
    assert f.least < f.depth

    def edges(rows):
        return spark.createDataFrame(rows, "a bigint, b bigint, shared int")

    sure = [(i, i + 1, 8) for i in range(0, 40, 2) for _ in range(f.trees)]  # alike in all trees
    assert n.matched_depth(edges(sure), f) == f.depth
    less = [(i, i + 1, 8) for i in range(100, 140, 2) for _ in range(5)]  # about 0.82
    assert n.matched_depth(edges(sure + less), f) < f.depth
    assert n.matched_depth(edges([]), f) == f.least


def test_shingles_are_position_free():
    a = n.shingles(b"p q a b c d e f")
    assert set(n.shingles(b"a b c d e f").tolist()) <= set(a.tolist()) and len(a) == 4
    assert len(n.shingles(b"a b")) == 1 and len(n.shingles(b"")) == 0


def test_shingles_of_long_texts_in_parts(monkeypatch):
    text = b" ".join(b"w%d" % (i * i % 97) for i in range(500)) + b" " + b"x" * 90 + b" a b c d e f"
    whole = n.shingles(text)
    for most in (20, 64, 333):
        monkeypatch.setattr(n, "_AT_ONCE", most)
        assert (n.shingles(text) == whole).all()


def test_empty(spark):
    assert n.report(empty_docs(spark)).count() == 0
    assert n.one_of_each(empty_docs(spark)).count() == 0
