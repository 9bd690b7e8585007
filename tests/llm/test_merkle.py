import zlib
from hashlib import sha256

import pytest
from llm.helpers import EDGE, docs_of, empty_docs

from logmetrics.llm import merkle as m


def sha(s):
    return sha256(s.encode()).hexdigest()


def plain_leaf(row, text):
    parts = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts))


def plain_tree(nodes):
    """Subroot, and each node's siblings as (left, right) lists from the bottom up."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, i in zip(ways, at, strict=True):
            a = i // 3 * 3
            way.append((nodes[a:i], nodes[i + 1 : a + 3]))
        at = [i // 3 for i in at]
        nodes = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], ways


def expected(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i].source is not None, (rows[i].source or "").encode(), rows[i].doc_id is not None, rows[i].doc_id or 0, plain_leaf(rows[i], rows[i].text)))
    groups = {}
    for i in order:
        groups.setdefault(rows[i].source, []).append(i)
    made = [(ids, *plain_tree([plain_leaf(rows[i], rows[i].text) for i in ids])) for ids in groups.values()]
    root, above = plain_tree([g[1] for g in made])
    out = []
    for (ids, subroot, ways), outer in zip(made, above, strict=True):
        for i, way in zip(ids, ways, strict=True):
            r, way = rows[i], way + outer
            text = r.text
            even = (zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 0) % 2 == 0
            cur = plain_leaf(r, text.replace("\n", "") if text is not None and even else text)
            for left, right in way:
                cur = sha("".join([*left, cur, *right]))
            proof = sha("".join(s for left, right in way for s in (*left, *right)))
            out.append((r.doc_id, plain_leaf(r, text), subroot, root, proof, cur, cur == root))
    return sorted(out, key=str)


def result(docs, height=m.HEIGHT):
    return sorted(map(tuple, m.report(docs, height).collect()), key=str)


def table(spark, sizes):
    rows = []
    for source, n in sizes.items():
        rows += [(len(rows) + 7 * i % 1000, f"text {i}\nof\n{source}" if i % 3 else f"line {i}", "en", source, i) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5)


@pytest.mark.parametrize("height", [1, 2, 7])
def test_report_equals_a_plain_tree(spark, height):
    # Low superblocks make several levels: 200 leaves are five levels of height 1.
    sizes = {"hot": 200, "b": 1, "a": 3, None: 28, "é": 9, "Z": 10, "": 4, "zz": 2, "q1": 27, "q2": 1, "q3": 1}
    docs = table(spark, sizes)
    got = result(docs, height)
    assert got == expected(docs.collect())
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [{"one": 1}, {"one": 100}, {"a": 1, "b": 1}, {None: 2}])
def test_small_trees(spark, sizes):
    docs = table(spark, sizes)
    assert result(docs) == expected(docs.collect())


def test_nulls_ties_and_repeated_rows(spark):
    docs = docs_of(spark, [*EDGE, (5, "another text\nwith the same id"), (None, None), (None, None)])
    got = result(docs)
    assert got == expected(docs.collect())
    assert sum(r[0] is None for r in got) == 3
    assert m.report(empty_docs(spark)).collect() == []


def test_proof_lists_fold_and_keys_keep_their_type(spark):
    keys = spark.createDataFrame([(f"k{i}", "g", sha(str(i)), sha(str(i + i % 2))) for i in range(40)], "key string, `group` string, leaf string, claim string")
    for r in m.prove(keys).collect():
        assert m.fold(r.leaf, r.left, r.right) == r.root == r.subroot
        assert m.fold(r.claim, r.left, r.right) == r.folded
        assert (r.folded == r.root) == (r.leaf == r.claim)
    big = 2**60 + 1
    docs = docs_of(spark, [(big, "x\ny"), (None, "z")])
    assert {r.doc_id for r in m.report(docs).collect()} == {big, None}


def test_superblocks_in_a_hot_group(spark):
    # More leaves in one group than a superblock holds, at the real size.
    n = 2 * m.BLOCK + 5
    rows = spark.range(n).selectExpr("id AS key", "'hot' AS `group`", "sha2(string(id), 256) AS leaf", "sha2(string(id), 256) AS claim")
    out = m.prove(rows).collect()
    root, ways = plain_tree([sha(str(i)) for i in range(n)])
    want = {i: (["".join(a) for a, _ in w], ["".join(b) for _, b in w]) for i, w in enumerate(ways)}
    assert len(out) == n and all(r.root == r.folded == root and want[r.key] == (r.left, r.right) for r in out)
