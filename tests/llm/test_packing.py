import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import EDGE, docs_of, empty_docs
from tokenizers import Tokenizer

from logmetrics.llm import packing as p

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
ENCODER = p.Encoder()
SMALL = p.Encoder(capacity=32)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x180), st.sampled_from("'stremdl <|>KİΣ")), max_size=40), max_size=4))
def test_encoder_equals_the_tokenizer(texts):
    want = [np.array(ids_of(t), dtype="<u4").tobytes() for t in texts]
    assert ENCODER.encode(texts) == want
    assert SMALL.encode(texts) == want


def test_encoder_special_tokens_and_null():
    texts = [None, "", "a<|endoftext|>b", "it's we'll 12½", "Ünï\x85cöde\xa0x", "the the the"]
    assert ENCODER.encode(texts) == [np.array(ids_of(t), dtype="<u4").tobytes() for t in texts]


def check(rows, docs):
    """Pieces rebuild each document; sequences are gapless and within the capacity."""
    want = defaultdict(int)
    for i, t in docs:
        ids = [*ids_of(t), 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            want[i, k, a, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    have, bins = defaultdict(int), defaultdict(list)
    for r in rows:
        have[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        bins[r.sequence_id].append((r.offset, r.length))
    assert have == want
    for b in bins.values():
        at = 0
        for off, n in sorted(b):
            assert off == at
            at += n
        assert at <= 2048
    return len(bins)


def test_report(spark):
    docs = [*EDGE, *((100 + i, f"word{i} " * (7 * i % 900)) for i in range(120))]
    rows = p.report(docs_of(spark, docs)).collect()
    assert check(rows, docs) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_many_groups(spark):
    docs = [(i, f"w{i} " * (37 * i % 400)) for i in range(300)]
    parts = p.pieces(docs_of(spark, docs).select("doc_id", "text"))
    rows = p.assign(parts, group=50).collect()
    assert check(rows, docs) <= -(-sum(r.length for r in rows) // 2048) + 6


def test_sequences_hold_the_tokens(spark):
    docs = [(1, "some words here"), (2, "x " * 3000), (3, None)]
    packed = p.assign(p.pieces(docs_of(spark, docs).select("doc_id", "text"), with_ids=True))
    seqs = [r.ids for r in p.sequences(packed).collect()]
    assert all(len(s) <= 2048 for s in seqs)
    assert sorted(x for s in seqs for x in s) == sorted(x for _, t in docs for x in [*ids_of(t), 0])


def test_clashing_columns(spark):
    out = p.pieces(docs_of(spark, [(1, "a b")]))
    assert "length" in out.columns and "length_" in out.columns


def test_empty(spark):
    assert p.report(empty_docs(spark)).count() == 0


def test_local_search_beats_best_fit():
    # Best fit in falling order needs three bins of 10; moving parts gives two full ones.
    lengths = np.array([6, 4, 4, 3, 3])
    assert len(set(p.pack(lengths, 10).tolist())) == 2


def best_fit(lengths, capacity):
    """The first bins alone."""
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b, x in enumerate(free) if x >= n]
        b = min(fits, key=lambda b: free[b]) if fits else len(free)
        free[b : b + 1] = [(free[b] if fits else capacity) - n]
    return len(free)


@pytest.mark.parametrize("low, high, share", [(600, 760, 1.02), (400, 512, 1.1), (500, 900, 1.07)])
def test_search_empties_bins_of_best_fit(low, high, share):
    """Lengths of which best fit in falling order wastes room: at a realistic size."""
    lengths = np.random.default_rng(low).integers(low, high, 4000)
    bins = p.pack(lengths)
    fill = np.bincount(bins, weights=lengths)
    assert fill.max() <= p.CAPACITY and fill.min() > 0
    bound = -(-int(lengths.sum()) // p.CAPACITY)
    assert len(fill) <= share * bound and len(fill) < best_fit(lengths.tolist(), p.CAPACITY)


def test_each_step_raises_the_squared_fill():
    rng = np.random.default_rng(1)
    lengths = rng.integers(20, 70, 80)
    search = p._Search(lengths, np.arange(80) // 2, 140)
    before = (search.fill**2).sum()
    steps = 0
    for b in list(range(40)) * 3:
        while 0 < search.fill[b] < 140 and search._step(b):
            now = (search.fill**2).sum()
            assert now > before and search.fill.max() <= 140
            assert (search.fill == np.bincount(search.bin_of, weights=lengths, minlength=40)).all()
            before, steps = now, steps + 1
    assert steps > 40 and (search.fill == 0).any()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_pack_is_valid(lengths):
    bins = p.pack(np.array(lengths, dtype=np.int64), 100)
    fill = np.bincount(bins, weights=lengths) if lengths else np.zeros(0)
    assert (fill <= 100).all() and (fill > 0).all()
