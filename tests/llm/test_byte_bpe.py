import base64
import hashlib

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import EDGE, docs_of, empty_docs

from logmetrics.llm import byte_bpe as b

RAW = open(public_tokenizers.path(b.VOCABULARY), "rb").read()
RANKS = {base64.b64decode(x): int(y) for x, y in map(bytes.split, RAW.splitlines())}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = b.Codec(RANKS, public_tokenizers.PATTERN)
TINY = b.Codec(RANKS, public_tokenizers.PATTERN, cache=3)


def ids_of(codec, text):
    return codec.encode([text])[0].tolist()


def plain_merge(ranks, piece):
    """Scan all pairs for the least rank, leftmost first, and merge; no tree."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aeinrst' \n\t19ñß")), max_size=60))
def test_encode_equals_the_library(text):
    want = LIBRARY.encode_ordinary(text)
    assert ids_of(CODEC, text) == want
    assert ids_of(TINY, text) == want
    assert [x.tolist() for x in TINY.encode([text, None, text + "s"])] == [want, [], LIBRARY.encode_ordinary(text + "s")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.binary(min_size=1, max_size=80), st.text(alphabet="theraonis ", min_size=1, max_size=30).map(str.encode)), max_size=9))
def test_merge_equals_a_plain_scan(pieces):
    want = [plain_merge(RANKS, p) for p in pieces]
    assert [CODEC.merge(p) for p in pieces] == want
    assert CODEC.merge_many(pieces) == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab", min_size=1, max_size=40))
def test_ties_go_to_the_left(text):
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"ab": 257, b"aaa": 258, b"ba": 259, b"aab": 260, b"abab": 261}
    codec, want = b.Codec(ranks, r"\S+"), plain_merge(ranks, text.encode())
    assert codec.merge(text.encode()) == want and codec.merge_many([text.encode()]) == [want]


def test_a_match_that_is_a_token_is_not_merged():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"xyz": 257}  # xyz can't be reached by merges
    codec = b.Codec(ranks, r"\S+")
    assert ids_of(codec, "xyz") == [257] and ids_of(codec, "xyzab") == [120, 121, 122, 256]


def test_long_match_and_portions(monkeypatch):
    long = "abcdefghij" * 20_000
    assert ids_of(CODEC, long) == LIBRARY.encode_ordinary(long)
    monkeypatch.setattr(b, "WHOLE_CHARS", 10)
    monkeypatch.setattr(b, "PORTION", 3)
    text = "  it's 12 words,\n\n ñandú   done " * 5
    assert ids_of(CODEC, text) == LIBRARY.encode_ordinary(text)


def test_report_equals_the_library(spark):
    rows = [*EDGE, (20, "naïve café \U0001f600 日本語 <|endoftext|>"), (21, "a" * 5000), (22, "   \r\n")]
    got = sorted(map(tuple, b.report(docs_of(spark, rows)).collect()), key=str)
    want = []
    for i, t in rows:
        ids = LIBRARY.encode_ordinary(t or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((i, len(ids), digest, hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_operator_keeps_columns_and_takes_null_ids(spark):
    docs = docs_of(spark, [(1, "some words"), (2, None)]).withColumnRenamed("key", "ids")
    out = b.encode(docs)
    assert out.columns == [*docs.columns, "ids_"]
    back = {r.doc_id: bytes(r.decoded) for r in b.decode(out, ids="ids_").collect()}
    assert back == {1: b"some words", 2: b""}
    ids = spark.createDataFrame([(1, None), (2, [100, 300]), (3, [])], "doc_id int, ids array<int>")
    assert [bytes(r.decoded) for r in b.decode(ids).orderBy("doc_id").collect()] == [b"", LIBRARY.decode_bytes([100, 300]), b""]
    assert b.report(empty_docs(spark)).count() == 0


def test_unknown_id_and_missing_byte(spark):
    with pytest.raises(Exception, match="no token"):
        b.decode(spark.createDataFrame([([999_999],)], "ids array<int>")).collect()
    with pytest.raises(ValueError, match="lacks a byte"):
        b.Codec({b"a": 0}, r"\S+").encode(["ab"])


def test_pattern_covers_every_character():
    text = "x\u0085y​z﻿ \x00\x1f~́"
    assert "".join(regex.findall(public_tokenizers.PATTERN, text)) == text
