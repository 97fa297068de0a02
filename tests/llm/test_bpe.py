"""Merge replay against the tokenizer library."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.llm import merge_replay, queries

from .conftest import ODD

VOCAB = merge_replay.vocabulary()
LIBRARY = tiktoken.Encoding(
    "library", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCAB.ranks, special_tokens={}
).encode_ordinary


def one_by_one(word, ranks):
    """Merge the leftmost pair of least rank until there is none."""
    if word in ranks:
        return [ranks[word]]
    parts = [bytes([b]) for b in word]
    while True:
        known = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not known:
            return [ranks[p] for p in parts]
        _, at = min(known)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


pieces = st.lists(st.sampled_from(["a", "e", "r", "th", "in", "ing", "=", "-", "é", "日", " ", "\n", "1", "ll"]), max_size=80)


@given(st.lists(pieces.map("".join), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_ids_are_those_of_the_library(texts):
    got = list(merge_replay.Encoder().encode(texts))
    assert [g.tolist() for g in got] == [LIBRARY(t) for t in texts]
    assert [merge_replay.decode_ids(g.astype(np.int64), VOCAB) for g in got] == [t.encode() for t in texts]


#: Merges in whose words an earlier rank turns up only later, and overlapping pairs of all kinds.
TURNING = {b"a": 0, b"b": 1, b"c": 2, b"abc": 3, b"bca": 4, b"ab": 5, b"aa": 6, b"ca": 7, b"abab": 8, b"aaa": 9, b"cab": 10}


@given(st.lists(st.text(alphabet="abc", min_size=1, max_size=14), min_size=1, max_size=8))
@settings(max_examples=500, deadline=None)
def test_merges_out_of_rank_order(words):
    ranks = TURNING | {bytes([b]): 100 + b for b in range(256) if bytes([b]) not in TURNING}
    words = [w.encode() for w in words]
    ids, counts = merge_replay.replay(words, merge_replay.Vocabulary(ranks))
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == [one_by_one(w, ranks) for w in words]


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 3000, " " * 5000, "=-" * 4000, "é" * 3000, "lol" * 900 + "日本" * 99])
def test_long_words(text, monkeypatch):
    monkeypatch.setattr(merge_replay, "LONG_TEXT", 1000)
    assert next(merge_replay.Encoder().encode([text])).tolist() == LIBRARY(text)


def test_every_code_point_is_cut_alike():
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"the{c}{c}1{c}!{c} {c}  x" for c in chars[at : at + 2000]) for at in range(0, len(chars), 2000)]
    for text, got in zip(texts, merge_replay.Encoder().encode(texts), strict=True):
        assert got.tolist() == LIBRARY(text)


def test_forgotten_words_come_again():
    texts = [["one two", "three"], ["two four", None], ["one", "five six"]]
    encoder = merge_replay.Encoder(most_words=2)
    assert [[g.tolist() for g in encoder.encode(t)] for t in texts] == [[LIBRARY(x or "") for x in t] for t in texts]


def test_odd_rows(odd, none, monkeypatch):
    encoded = merge_replay.encode(odd, keep=odd.columns)
    assert encoded.columns == [*odd.columns, "ids"]
    rows = merge_replay.decode(encoded, keep=["doc_id", "ids", "score"]).collect()
    want = Counter((d, tuple(LIBRARY(t or "")), (t or "").encode()) for d, t in ODD)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in rows) == want
    assert merge_replay.decode(merge_replay.encode(none)).count() == 0


def test_a_column_named_like_the_text_that_is_read(spark):
    rows = spark.createDataFrame([(1, "one text", "x"), (2, None, None)], "doc_id int, text string, _text string")
    encoded = merge_replay.encode(rows, keep=rows.columns)
    assert encoded.columns == [*rows.columns, "ids"]
    got = {r.doc_id: (r.text, r["_text"], tuple(r.ids)) for r in encoded.collect()}
    assert got == {1: ("one text", "x", tuple(LIBRARY("one text"))), 2: (None, None, ())}


def test_unknown_ids_have_no_bytes(spark):
    rows = spark.createDataFrame([(1, [0, 60_000]), (2, None), (3, [-1]), (4, []), (5, [None, 3])], "doc_id int, ids array<int>")
    got = {r.doc_id: r.decoded for r in merge_replay.decode(rows).collect()}
    assert got == {1: None, 2: None, 3: None, 4: bytearray(), 5: None}


def test_query(spark, docs, texts):
    rows = queries.op11_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = LIBRARY(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_blocks_and_batches(docs, texts, monkeypatch):
    monkeypatch.setattr(merge_replay, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(merge_replay, "BATCH_IDS", 50)
    rows = merge_replay.encode(docs.where(F.col("doc_id") < 40)).collect()
    assert {r.doc_id: r.ids for r in rows} == {d: LIBRARY(t or "") for d, t in texts.items() if d < 40}
