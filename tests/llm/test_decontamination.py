import re

from llm.helpers import EDGE, docs_of, empty_docs

from logmetrics.llm import decontamination as d


def plain_words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    wins = []
    for i, t in items:
        w = plain_words(t)
        n = min(10, len(w))
        wins += [(i, tuple(w[k : k + n])) for k in range(len(w) - n + 1)] if n else []
    out = {}
    for i, t in docs:
        w, hit, found = plain_words(t), set(), set()
        for item, x in wins:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit |= set(range(k, k + len(x)))
                    found.add(item)
        out[i, t] = (len(w), len(hit), len(found - {None}), d.checksum(found - {None}), bool(hit))
    return out


TEN = "One two three four five six seven eight nine ten"
ITEMS = [(1, TEN + " eleven"), (2, "tiny item"), (3, None), (4, ""), (5, "!!"), (None, "no id here"), (2, "another row of item two"), (12, "Ünïcode wörds zählen")]
DOCS = [
    (10, f"x {TEN.upper()}, ELEVEN y {TEN} z"),
    (11, "a tiny   item; and a tiny-item"),
    (12, "no id here and another row of item two"),
    (13, "one two three four five six seven eight nine"),
    (14, "ünïcode wörds zählen ÜnÏcode"),
    (15, f"{TEN} eleven {TEN} eleven tiny item"),
    *EDGE,
]


def table(spark, items):
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, score int")


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


def test_report_equals_brute_force(spark):
    want = brute(DOCS, ITEMS)
    rows = sorted(((i, *want[i, t]) for i, t in DOCS), key=str)
    assert got(d.report(docs_of(spark, DOCS), table(spark, ITEMS))) == rows


def test_blocks_give_the_same(spark):
    docs, items = docs_of(spark, DOCS), table(spark, ITEMS)
    one = d.find_contamination(docs, items).select("doc_id", "contamination").collect()
    many = d.find_contamination(docs, items, max_block_words=4).select("doc_id", "contamination").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_removal(spark):
    docs, items = docs_of(spark, DOCS), table(spark, ITEMS)
    left = d.remove_documents(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 2, 3, 4, 5, 5, 6, 13, 14]
    cut = {r.doc_id: r.text for r in d.remove_spans(docs, items).collect()}
    assert cut[10] == "x  y  z" and cut[13] == DOCS[3][1] and cut[1] is None
    assert not any(r.contaminated for r in d.report(d.remove_spans(docs, items), items).collect())


def test_empty_tables(spark):
    assert d.report(empty_docs(spark), table(spark, ITEMS)).count() == 0
    clean = d.report(docs_of(spark, DOCS), table(spark, []))
    assert not any(r.contaminated for r in clean.collect())


def test_item_ids_of_any_type(spark):
    docs = docs_of(spark, DOCS)
    text = spark.createDataFrame([(f"q-{i}" if i is not None else None, t, 1) for i, t in ITEMS], "item_id string, text string, score int")
    for how in ({}, {"max_block_words": 4}):
        found = d.find_contamination(docs, text, **how)
        assert dict(found.select("contamination.items").dtypes)["items"] == "array<string>"
        ints = {r.doc_id: r.contamination["items"] for r in d.find_contamination(docs, table(spark, ITEMS), **how).collect() if r.doc_id}
        for r in found.collect():
            if r.doc_id:
                assert r.contamination["items"] == sorted(f"q-{i}" for i in ints[r.doc_id])


def test_blocks_are_stored_in_between(spark):
    plan = d.find_contamination(docs_of(spark, DOCS), table(spark, ITEMS), max_block_words=4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Python UDF" not in plan and "PythonEval" not in plan
