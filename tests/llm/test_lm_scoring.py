import math
import zlib
from collections import Counter

import numpy as np
from llm.helpers import EDGE, docs_of, empty_docs

from logmetrics.llm import gru
from logmetrics.llm import lm_scoring as m


def layout():
    return gru.Layout(np.array([0, 3, 5]), 4)


def params(seed=0, scale=0.5):
    p = gru.Params(layout())
    p.flat[:] = np.random.default_rng(seed).standard_normal(len(p.flat)) * scale
    return p


def plain_score(p, lay, text):
    """One token at a time, straight from the definition."""
    sig = lambda x: 1 / (1 + math.e ** -x)
    h, total, k = np.zeros(gru.HIDDEN), 0.0, gru.HIDDEN
    for t in text:
        logits = h @ p.cls + p.cls_b
        c = int(lay.class_of(np.array([t]))[0])
        total += logits[c] - np.log(np.exp(logits).sum())
        if c < lay.n_fine:
            a, b = lay.start[c], lay.start[c + 1]
            logits = p.out[a:b] @ h + p.out_b[a:b]
            total += logits[t - a] - np.log(np.exp(logits).sum())
        gx, gh = p.emb[t] @ p.w + p.b, h @ p.u
        z, r = sig(gx[:k] + gh[:k]), sig(gx[k : 2 * k] + gh[k : 2 * k])
        h = (1 - z) * np.tanh(gx[2 * k :] + r * gh[2 * k :]) + z * h
    return total


TEXTS = [np.array(x) for x in ([0, 1, 6], [2], [4, 5, 3, 3, 1, 0, 2, 6, 5] * 9, [6, 6, 0, 1], [5])]


def test_scores_equal_a_plain_walk():
    p = params()
    want = [plain_score(p, layout(), t) for t in TEXTS]
    for lanes, steps, window in ((1, 4, 0), (2, 7, 0), (8, 100, 0), (4, 2, 12), (4, 1, 1000)):
        assert np.allclose(gru.score(p, layout(), TEXTS, lanes, steps, window), want, atol=1e-3)
    assert len(gru.score(p, layout(), [])) == 0


def test_probabilities_sum_to_one():
    p, lay = params(1), layout()
    for start in ([], [0, 4]):
        total = sum(math.exp(plain_score(p, lay, [*start, t]) - plain_score(p, lay, start)) for t in range(lay.n_inputs))
        assert abs(total - 1) < 1e-5


def test_gradient():
    """Back-propagation within one window equals differences of the loss."""
    p, lay = params(2), layout()
    p.flat = p.flat.astype(np.float64)
    p = gru.Params(lay, p.flat)
    lanes = gru.Lanes(TEXTS[:2], 2)
    k, at = next(iter(lanes.windows(3)))
    real = at >= 0
    tokens, fresh = np.where(real, lanes.flat[at], 0), real & lanes.fresh[at]

    def loss(q):
        before, _, _ = gru.run(q, np.zeros((k, gru.HIDDEN), dtype=np.float32), tokens, fresh)
        return -float(gru.log_likelihood(q, lay, before[real], tokens[real])[0].sum())

    g = gru.Params(lay)
    before, _, saved = gru.run(p, np.zeros((k, gru.HIDDEN), dtype=np.float32), tokens, fresh, keep=True)
    d = np.zeros_like(before)
    _, d_real = gru.log_likelihood(p, lay, before[real], tokens[real], g)
    d[real] = d_real
    gru._backward(p, g, tokens, fresh, before, saved, d)
    rng = np.random.default_rng(0)
    for i in rng.choice(len(p.flat), 60, replace=False):
        up, down = gru.Params(lay, p.flat), gru.Params(lay, p.flat)
        up.flat[i] += 1e-2
        down.flat[i] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - g.flat[i]) < 2e-2


def test_training_lowers_the_loss():
    rng, lay = np.random.default_rng(3), layout()
    texts = [np.array([(i + s) % 5 for i in range(20)] + [6]) for s in rng.integers(0, 5, 200)]
    p = gru.initial(lay, np.ones(4), np.ones(5))
    before = gru.score(p, lay, texts).sum()
    assert gru.score(gru.train(p, lay, texts * 8, 0.03, 96), lay, texts).sum() > 0.5 * before


def test_segments_count_every_token_once():
    texts = [np.arange(n) + 100 * n for n in (1, 7, 10, 11, 35)]
    parts, warm = gru.segments(texts, 10, 4)
    assert max(map(len, parts)) <= 14
    own = [p[w:] for p, w in zip(parts, warm, strict=True)]
    assert np.concatenate(own).tolist() == np.concatenate(texts).tolist()
    lanes = gru.Lanes(parts, 3, warm)
    assert sorted(lanes.flat[lanes.counts].tolist()) == sorted(np.concatenate(texts).tolist())
    starts = np.flatnonzero(lanes.fresh)
    assert len(starts) == len(parts) and sum(~lanes.counts) == sum(warm)
    for a in starts:  # what doesn't count stands at a segment's start
        part = lanes.text[a]
        assert (~lanes.counts[a : a + len(parts[part])]).tolist() == [i < warm[part] for i in range(len(parts[part]))]


def test_segments_train_as_whole_texts_do():
    rng, lay = np.random.default_rng(5), layout()
    texts = [np.array([(i + s) % 5 for i in range(400)] + [6]) for s in rng.integers(0, 5, 60)]
    p = gru.initial(lay, np.ones(4), np.ones(5))
    whole = gru.score(gru.train(p, lay, texts, 0.02, 16, most=1000), lay, texts).sum()
    cut = gru.score(gru.train(p, lay, texts, 0.02, 16, most=50), lay, texts).sum()
    assert cut > 1.5 * whole and cut > 0.5 * gru.score(p, lay, texts).sum()


def test_every_text_is_learned_from(spark, monkeypatch):
    """The rounds' tokens are those of all training texts, once, however large the table."""
    learned = []
    average = m._tree_average

    def seen(rows):
        rows = m.store(rows, "seen")
        learned.extend(r["weight"] for r in rows.collect())
        return average(rows)

    monkeypatch.setattr(m, "_tree_average", seen)
    docs = docs_of(spark, [(i, f"aa bb cc dd{i % 9} ee" * (i % 5)) for i in range(300)] + EDGE)
    v = m.build_vocabulary(m.count_tokens(docs))
    n, v.n = v.n, 10**9
    m.train(docs, v)
    assert sum(learned) == n and len(learned) >= m.ROUNDS


def test_texts_in_bounded_lists():
    texts = [np.arange(n) for n in (3, 4, 50, 0, 6, 4, 1)]
    got = list(m._bounded(texts, 10))
    assert [len(x) for part in got for x in part] == [3, 4, 50, 0, 6, 4, 1]
    assert all(sum(map(len, part)) <= 10 or len(part) == 1 for part in got) and list(m._bounded([])) == []


def held_out(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0


def test_base_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    docs = [(i, " ".join(f"W{int(x)}" for x in rng.zipf(1.3, 30) % 500)) for i in range(120)] + EDGE
    monkeypatch.setattr(m, "VOCABULARY", 40)
    monkeypatch.setattr(m, "DICTIONARY", 60)  # most words go by the join
    out = m.report(docs_of(spark, docs)).collect()
    tok = lambda t: [*(t or "").lower().encode().split(), b""]
    c = Counter(w for i, t in docs if not held_out(i) for w in tok(t))
    n, v = sum(c.values()), len(c)
    want = sorted(
        ((i, held_out(i), len(tok(t)), sum(c[w] > 0 for w in tok(t)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tok(t)), 6)) for i, t in docs), key=str
    )
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out), key=str) == want
    assert all(r.score < 0 for r in out)


def test_vocabulary_distribution(spark, monkeypatch):
    """Over network words and one unknown per ending, all probabilities sum to one."""
    monkeypatch.setattr(m, "VOCABULARY", 5)
    docs = docs_of(spark, [(i, f"aa bb cc dd ee ff gg{i} hh{i % 3}") for i in range(30)])
    counts = m.count_tokens(docs)
    v = m.build_vocabulary(counts)
    p = gru.initial(v.layout, v.class_counts, v.word_counts)
    ll = [gru.score(p, v.layout, [np.array([t])])[0] for t in range(v.layout.n_inputs)]
    assert abs(np.exp(ll).sum() - 1) < 1e-4
    table = {bytes(r.word): r.c for r in counts.collect()}
    tail = {w: c for w, c in table.items() if w not in v.number}
    for e, k in v.endings.items():
        of = [c for w, c in tail.items() if v.endings.get(w[-2:], v.endings[b""]) == k]
        assert abs(10 ** v.tail_log[k] - (sum(of) + m.SMOOTH * (len(of) + 1))) < 1e-6, e


def test_tree_average(spark, monkeypatch):
    monkeypatch.setattr(m, "_FAN", 2)
    rows = [(float(i + 1), np.full(3, i, dtype=np.float32).tobytes()) for i in range(7)]
    got = m._tree_average(spark.createDataFrame(rows, "weight double, params binary"))
    assert np.allclose(got, sum((i + 1) * i for i in range(7)) / 28)


def test_edges(spark):
    assert m.report(empty_docs(spark)).count() == 0
    out = m.report(docs_of(spark, [(i, None) for i in range(20)])).collect()
    assert {(r.n_tokens, r.n_known) for r in out} == {(1, 1)}


def test_long_texts_in_parts_score_the_same(spark, monkeypatch):
    docs = [(i, " ".join(f"w{(i * k) % 13}" for k in range(60)) + "  ") for i in range(40)] + EDGE[:4]
    df = docs_of(spark, docs).select("doc_id", "text")
    counts = m.count_tokens(df)
    v = m.build_vocabulary(counts)
    p = gru.initial(v.layout, v.class_counts, v.word_counts)

    def rows():
        fields, make = m._scan_fields(v, p.flat)
        out = make()([t.encode() if t is not None else None for _, t in docs])
        return [list(map(str, x)) if k in (0, 1, 4) else np.round(x, 4).tolist() for k, x in enumerate(out)]

    whole = rows()
    monkeypatch.setattr(m, "_AT_ONCE", 17)
    assert rows() == whole
    assert whole[0] == [str(len(m.tokens((t or "").encode()))) for _, t in docs]
