import random

from logmetrics.llm import components as c


def test_chains_settle_in_few_rounds(spark, monkeypatch):
    """A chain of 1,000 nodes, in order and mixed, and a star and a ring beside it."""
    rounds = []
    stored = c.store
    monkeypatch.setattr(c, "store", lambda df, name: rounds.append(name) or stored(df, name))
    mixed = list(range(1000, 2000))
    random.Random(5).shuffle(mixed)
    chains = [list(range(1000)), mixed, [3000, 3002, 3001, 3003, 3000]]
    edges = [e for chain in chains for e in zip(chain[1:], chain, strict=False)] + [(4000 + i, 4050) for i in range(1, 100)]
    got = {r.node: r.component for r in c.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: min(chain) for chain in chains for x in chain} | {4000 + i: 4001 for i in range(1, 100)}
    assert got == want
    assert rounds.count("labels") <= 20


def test_binary_nodes_and_none(spark):
    got = c.components(spark.createDataFrame([(b"b", b"a"), (b"c", b"b"), (b"x", b"x")], "a binary, b binary")).collect()
    assert {(bytes(r.node), bytes(r.component)) for r in got} == {(b"a", b"a"), (b"b", b"a"), (b"c", b"a")}
    assert c.components(spark.createDataFrame([], "a long, b long")).count() == 0
