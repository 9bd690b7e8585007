import math
import random

from llm.helpers import EDGE, docs_of, empty_docs

from logmetrics.llm import toxicity as t


def corpus(n=900, seed=3):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abdefgilmnoprstu") for _ in range(r.randint(2, 7))) for _ in range(400)]
    bad = ["grumblo", "vexarmi", "zorpak"]
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(vocab) for _ in range(r.randint(5, 120))]
        y = int(r.random() < 0.25)
        if y:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randrange(len(words)), r.choice(bad) + r.choice(["", "s", "ing"]))
        elif r.random() < 0.05:
            words.insert(r.randrange(len(words)), "harmless zorpak")
        rows.append((i, " ".join(words)))
        labels.append((i, y))
    return rows, labels


def test_fold():
    assert t.fold_text("1d10T nаïvе\u200b").split() == ["idiot", "naive"]
    assert t.fold_text("Ёж") == " eж " and t.fold_text("$h1t-b4d") == " shit bad "
    assert t.fold_text("ѕtupіd") == " stupid " and t.fold_text(None) == "  "


def plain_score(model, text):
    """Every entry by plain substring search at every place, one text at a time."""
    folded = t.fold_text(text)
    total = 0.0
    for entry, weight in [*model.weights.items(), *((e, -w) for e, w in model.exceptions.items())]:
        total += weight * sum(folded.startswith(entry, i) for i in range(len(folded)))
    total = max(0.0, total)
    b0, b1, b2 = model.coefficients
    z = b0 + b1 * math.log1p(total) + b2 * math.log1p(100 * total / max(len(folded.split()), 1))
    return 1 / (1 + math.exp(-z))


def test_scores_equal_plain_search(spark):
    """Overlapping and nested entries, ties, exceptions, repeated and long texts."""
    model = t.Model(
        weights={" grum": 2.0, " grumblo": 1.5, " zor": 0.5, " zorp": 0.5, " aa": 1.0, " aaaa": 0.25},
        exceptions={" harmless zorpak ": 1.0, " grum bar ": 2.0, " zor ": 0.5},
        coefficients=(-2.0, 0.7, 0.3),
    )
    r = random.Random(9)
    pool = ["grum", "grumblo", "Grumbl0", "zor", "zorpak", "harmless", "bar", "aaaa", "aaaaaa", "pl\u0430in", "words", "z0r", "!", "grum-bar"]
    rows = [(i, " ".join(r.choice(pool) for _ in range(r.randint(0, 30)))) for i in range(200)] + [(900 + (i or 0), x) for i, x in EDGE]
    rows.append((5000, "aaaa zorpak " * 20_000))
    got = {(x.doc_id, x.text): x.toxicity for x in t.score(docs_of(spark, rows), model).collect()}
    for i, text in rows[:-1]:
        assert abs(got[i, text] - plain_score(model, text)) < 1e-12, text
    assert 0.9 < got[rows[-1]] <= 1


def test_threshold_includes_ties(spark, monkeypatch):
    """A score of exactly the threshold is toxic, in the report and in the pipeline."""
    model = t.Model(coefficients=(math.log(0.3 / 0.7), 0.0, 0.0))
    monkeypatch.setattr(t, "fit", lambda *a, **k: model)
    docs = docs_of(spark, [(1, "one"), (2, None)])
    labels = spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int")
    score = t.score(docs, model).first().toxicity
    monkeypatch.setattr(t, "THRESHOLD", score)
    assert {r.predicted for r in t.report(docs, labels).collect()} == {1}
    assert t.remove_toxic(docs, labels, threshold=score).count() == 0
    assert t.remove_toxic(docs, labels, threshold=score + 1e-9).count() == 2


def test_held_out_accuracy_and_disguise(spark):
    rows, labels = corpus()
    docs, lab = docs_of(spark, rows), spark.createDataFrame([(i, y, 1) for i, y in labels], "doc_id bigint, toxic int, score int")
    out = {r.doc_id: r for r in t.report(docs, lab).collect()}
    held = [(y, out[i].predicted) for i, y in labels if out[i].held_out]
    assert len(held) > 150
    assert sum(a == b for a, b in held) / len(held) > 0.95
    model = t.fit(docs, lab)
    assert any(" harmless zorpak" in e for e in model.exceptions)
    probe = docs_of(spark, [(1, "grуmbl0 is here"), (2, "plain words only"), (3, "the harmless zorpak sings")])
    score = {r.doc_id: r.toxicity for r in t.score(probe, model).collect()}
    assert score[2] < 0.3 and score[3] < 0.3
    assert t.score(docs_of(spark, [(1, "GRUMBL0!")]), model).first().toxicity > 0.3


def test_edges(spark):
    rows, labels = corpus(300)
    docs = docs_of(spark, [*rows, *((None if i is None else 10_000 + i, x) for i, x in EDGE)])
    lab = spark.createDataFrame([*labels, (None, 1), (5, None), (10_001, 1), (7, labels[7][1])], "doc_id bigint, toxic int")
    out = t.report(docs, lab)
    assert out.count() == len(rows) + len(EDGE)
    assert all(0 <= r.score <= 1 for r in out.collect())
    kept = t.remove_toxic(docs, lab)
    assert kept.columns == docs.columns and 200 < kept.count() < len(rows) + len(EDGE)


def test_no_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.predicted for r in t.report(docs_of(spark, EDGE), none).collect()} == {0}
    assert t.report(empty_docs(spark), none).count() == 0
    one_class = spark.createDataFrame([(4, 0)], "doc_id bigint, toxic int")
    assert {r.predicted for r in t.report(docs_of(spark, EDGE), one_class).collect()} == {0}
