import importlib
import sys

import corpus_pipeline as c
from llm.helpers import DOCS
from llm.test_ngram_join import shingle_set
from llm.test_packing import check

from logmetrics.llm import decontamination, toxicity
from logmetrics.llm.common import table

SF = "/root/testdata/sf0.001"


def brute(spark, sf_dir):
    """The first four stages one document at a time, in memory."""
    docs = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), lambda i: ~toxicity.held_out(i))
    score = {r.doc_id: r.toxicity for r in toxicity.score(table(spark, sf_dir, "documents"), model).collect()}
    left = {i: t for i, t in docs.items() if score[i] < toxicity.THRESHOLD}
    sets = {i: shingle_set(t) for i, t in left.items()}
    group = {i: i for i in left}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in sorted(left):
        for j in sorted(left):
            if j < i and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if both / (len(sets[i]) + len(sets[j]) - both) >= 0.8 and root(i) != root(j):
                    a, b = sorted((root(i), root(j)))
                    group[b] = a
    left = {i: t for i, t in left.items() if root(i) == i}
    items = [(r.item_id, r.text.encode()) for r in table(spark, sf_dir, "benchmark").collect()]
    block = decontamination.WindowSet(items, decontamination.WINDOW)
    ids = list(left)
    hits = decontamination._scan_texts(block, [left[i].encode() for i in ids])[1]
    return {i: left[i] for i, s in zip(ids, hits) if not s}


def test_stages_keep_columns_and_rows(spark):
    docs = table(spark, SF, "documents")
    want = brute(spark, SF)
    before = docs
    for name, stage in c.STAGES[:-1]:
        after = c.store(stage(spark, before, SF), "test-stage")
        assert after.columns == docs.columns, name
        assert after.count() <= before.count()
        before = after
    kept = {r.doc_id: r.text for r in before.collect()}
    assert set(kept) == set(want)
    changed = {i for i in kept if kept[i] != want[i]}
    assert all("[SECRET]" in kept[i] for i in changed)
    rows = c.run(spark, SF).collect()
    assert check(rows, list(kept.items())) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_stages_take_odd_tables(spark):
    labels, rows = SF, [(None, "no id"), (1, None), (2, ""), (3, "word " * 3000), (3, "word " * 3000), (4, "token = \"0641917ea4e9feb9cda83477b57ac2654884f485\"")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 0.5, "k", 3, 9) for i, t in rows], DOCS)
    empty = docs.limit(0)
    for _, stage in c.STAGES[:-1]:
        docs, empty = stage(spark, docs, labels), stage(spark, empty, labels)
        assert docs.columns == empty.columns == [x.split()[0] for x in DOCS.split(", ")]
        docs, empty = c.store(docs, "t"), c.store(empty, "t")
    kept = sorted(docs.collect(), key=lambda r: str(r.doc_id))
    assert [r.doc_id for r in kept] == [1, 2, 3, 4, None] and kept[3].text == '[SECRET]"'
    assert empty.count() == 0
    assert c.STAGES[-1][1](spark, docs, labels).count() >= 5
    assert c.STAGES[-1][1](spark, empty, labels).count() == 0


def test_stage_order():
    assert [n for n, _ in c.STAGES] == ["toxicity", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "best-fit packing"]


def test_entry_without_the_subpackage(monkeypatch):
    """The rest imports and registers its queries when this folder and the pipeline are gone."""
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and sum(q.startswith("op") for q in entry.queries()) == 13
    gone = [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("logmetrics.llm")]
    for m in gone:
        monkeypatch.delitem(sys.modules, m)

    class Missing:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" or name.startswith("logmetrics.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Missing(), *sys.meta_path])
    plain = importlib.reload(entry).queries()
    assert "batch_metrics" in plain and not [q for q in plain if q.startswith("op") or q == "pipeline"]
    monkeypatch.undo()
    importlib.reload(entry)
