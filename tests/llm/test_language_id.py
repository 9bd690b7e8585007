import numpy as np
from llm.helpers import EDGE, docs_of, empty_docs
from pyspark.sql import functions as F

from logmetrics.llm import language_id as m

FULL = "doc_id bigint, text string, lang string, score double"


def naive_code_length(model, j, text):
    """Bits of one text under language ``j``: one symbol at a time from the root."""
    x = [0] * m.ORDER + [int(model.symbol_of[b]) for b in text]
    total = 0.0
    for i in range(m.ORDER, len(x)):
        node = 0
        for s in x[i - m.ORDER : i]:
            node = int(model.step[node, s])
        total += float(model.bits[node, x[i], j])
    return total


def small_model():
    en = [b"the cat sat on the mat and the dog ran to the river", b"this is the thing that the others thought of"] * 6
    de = ["der hund und die katze sind nicht über den fluß gegangen".encode(), b"das ist nicht der weg und ich will nicht"] * 6
    return m.learn(en + de, ["en"] * len(en) + ["de"] * len(de))


def test_distributions_sum_to_one():
    model = small_model()
    p = np.exp2(-model.bits[:, 1:, :].astype(float))
    rare = 256 - (model.bits.shape[1] - 2)
    total = p[:, 1:, :].sum(axis=1) + rare * p[:, 0, :]
    assert np.allclose(total, 1, atol=1e-3)


def test_code_lengths_equal_a_plain_walk(monkeypatch):
    model = small_model()
    texts = [b"the dog", b"", "über den wolken".encode(), b"x" * 50, bytes([200, 1, 7])]
    got = model.code_lengths(texts)
    want = [[naive_code_length(model, j, t) for j in range(2)] for t in texts]
    assert np.allclose(got, want, rtol=1e-5)
    monkeypatch.setattr(m, "_CHUNK", 7)
    assert np.allclose(model.code_lengths(texts), want, rtol=1e-5)


def test_longer_contexts_code_known_text_shorter():
    model = small_model()
    known = model.code_lengths([b"the cat sat on the mat"])[0]
    assert known[model.languages.index("en")] < 0.5 * known[model.languages.index("de")]


def test_report(spark):
    words = {"en": "the of and to river house with that which".split(), "fr": "le la été où maison avec rivière que dans".split()}
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(words[lang], 12)), lang, 1.0) for i in range(400) for lang in [["en", "fr"][i % 2]]]
    rows += [(1000, None, "en", 1.0), (1001, "", "fr", 0.0), (1002, "12 34 !!", "en", 0.0), (1003, "the river", None, 0.0), (None, "la maison", "fr", 0.0), (3, "la maison", "fr", 0.0)]
    out = m.report(spark.createDataFrame(rows, FULL)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out if r.doc_id is not None and r.doc_id != 3}
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 400 and r.doc_id != 3]
    assert len(held) > 40 and all(r.lang_pred == ["en", "fr"][r.doc_id % 2] for r in held)
    assert {by[i].lang_pred for i in (1000, 1001, 1002)} == {"und"} and by[1000].score == 0
    assert by[1003].lang_pred == "en" and 0 <= by[1003].score <= 1


def test_a_language_of_long_texts_only_is_learned(spark):
    words = {"en": "the of and to river house with that which".split(), "fr": "le la été où maison avec rivière que dans".split()}
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(words[lang], n)), lang, 1.0) for i in range(60) for lang, n in [[("en", 12), ("fr", 5000)][i % 2]]]
    out = m.report(spark.createDataFrame(rows, FULL)).collect()
    assert all(r.lang_pred == ["en", "fr"][r.doc_id % 2] for r in out)


def test_all_languages_are_learned_at_full_depth(spark, monkeypatch):
    """Many languages, in groups; each is told by its own words."""
    monkeypatch.setattr(m, "GROUP", 20)
    monkeypatch.setattr(m, "MAX_CELLS", 400_000)
    rng = np.random.default_rng(3)
    words = [["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(12)] for _ in range(130)]
    rows = [(i, " ".join(rng.choice(words[i % 130], 30)), f"l{i % 130}", 1.0) for i in range(130 * 12)]
    docs = spark.createDataFrame(rows, FULL)
    model = m.fit(docs, F.lit(True))
    assert len(model.models) == 7 and sorted(model.languages) == sorted({r[2] for r in rows})
    out = m.report(docs).where("held_out").collect()
    assert sum(r.lang_pred == f"l{r.doc_id % 130}" for r in out) > 0.95 * len(out) > 100


def test_edges(spark):
    assert m.report(empty_docs(spark)).count() == 0
    nolang = docs_of(spark, EDGE).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in m.report(nolang).collect()} == {"und"}
    out = m.predict(docs_of(spark, EDGE), small_model())
    assert out.count() == len(EDGE) and "score_" in out.columns
