"""Winnowing against a plain implementation, and the guarantee it gives."""

import hashlib
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import queries, winnow

from .conftest import ODD


def by_hand(text, gram=winnow.GRAM, window=winnow.WINDOW):
    """Chosen (hash, position) in text order."""
    words = [w for w in re.split(winnow.SEPARATORS, (text or "").lower()) if w]
    hashes = []
    for i in range(len(words) - gram + 1):
        h = 42
        for w in words[i : i + gram]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        hashes.append(h & (1 << 33) - 1)
    if words and not hashes:
        hashes = [xxhash.xxh64_intdigest(" ".join(words).encode(), 42) & (1 << 33) - 1]
    chosen = []
    for at in range(max(len(hashes) - window + 1, 1) if hashes else 0):
        part = list(enumerate(hashes[at : at + window], at))
        best = min(part, key=lambda p: (p[1], -p[0]))
        if (best[1], best[0]) not in chosen:
            chosen.append((best[1], best[0]))
    return chosen


def alike(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark, odd, none):
    repeated = [(100, "a b a b a b a b a b a b a b a b a b"), (101, "x y z"), (102, "x y z w v u t s"), (103, "Ab-Cd ef")]
    rows = [(d, t) for d, t in ODD if t is None or len(t) < 10_000] + repeated
    got = winnow.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r.doc_id, list(zip(r.hashes, r.positions, strict=True))) for r in got), key=key) == sorted(
        ((d, by_hand(t)) for d, t in rows), key=key
    )
    assert winnow.fingerprints(odd).count() == len(ODD) and winnow.fingerprints(none).count() == 0


@given(st.lists(st.sampled_from("abcdefgh"), min_size=8, max_size=8), st.lists(st.sampled_from("ab"), max_size=9), st.lists(st.sampled_from("cd"), max_size=9))
@settings(max_examples=200, deadline=None)
def test_a_long_common_run_is_always_found(run, before, after):
    a, b = " ".join([*before, *run, *after]), " ".join([*after, *run, *before])
    assert len(run) == winnow.GRAM + winnow.WINDOW - 1
    assert {h for h, _ in by_hand(a)} & {h for h, _ in by_hand(b)}


def edited_by_hand(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for (d, t), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        t, following = t or "", following or ""
        half = len(t) // 2
        out[d] = (t[: len(t) - half] + following[:half], following)
    return out


@pytest.mark.parametrize("parts", [1, 8])
def test_query(spark, texts, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = queries.op3_winnowing(spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = edited_by_hand(texts.items())
    assert len(got) == len(texts)
    for r in got:
        text, (edited, following) = texts[r.doc_id], want[r.doc_id]
        own, other = by_hand(text), by_hand(edited)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == " ".join(f"{h:x}" for h, _ in own)
        assert r.edited_fingerprint == " ".join(f"{h:x}" for h, _ in other)
        assert abs(r.near_edited - alike(own, other)) < 1e-9 and abs(r.near_next - alike(own, by_hand(following))) < 1e-9


def test_next_of_odd_rows(spark, odd, none):
    rows = winnow.compare_with_next(odd).collect()
    assert len(rows) == len(ODD) and winnow.compare_with_next(none).count() == 0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    assert winnow.compare_with_next(one).first().edited == "abcabc"
    missing = spark.createDataFrame([(None, "b b"), (None, "a")], "doc_id long, text string")
    assert sorted(r.edited for r in winnow.compare_with_next(missing).collect()) == ["a", "b a"]


def test_plan_stays_in_the_jvm(docs):
    plan = winnow.compare_with_next(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
