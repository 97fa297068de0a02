"""Restoring disguised words, and the scorer on held-out labels."""

import zlib

import numpy as np
import pytest

from newsloom.llm import deobfuscate, queries, toxicity
from newsloom.llm.deobfuscate import Restorer, trigram_counts

from .conftest import ODD

CORPUS = "the idiot and the moron went to the worthless trash heap with a pathetic loser who was stupid and happy " * 50


@pytest.fixture(scope="module")
def restorer():
    return Restorer(trigram_counts(CORPUS))


@pytest.mark.parametrize(
    "seen,meant",
    [
        ("1d10t", "idiot"),
        ("id!ot", "idiot"),
        ("tr@$h", "trash"),
        ("stuuuupid", "stupid"),
        ("w.o.r.t.h.l.e.s.s", "worthless"),
        ("l-o-s-e-r", "loser"),
        ("m0r0n", "moron"),
        ("p4th3t1c", "pathetic"),
        ("happy", "happy"),
    ],
)
def test_restored(restorer, seen, meant):
    assert restorer.token(seen) == meant


def test_words_of_a_text(restorer):
    found = restorer.words("The i d i o t, a l0ser (M0RON) in 2024: tr@sh!")
    assert {"idiot", "loser", "moron", "trash", "the", "in"} <= set(found)
    assert restorer.words("") == [] and restorer.words("12 34 --- …") == []


def test_plain_words_are_left_alone(restorer, texts):
    for text in list(texts.values())[:30]:
        plain = {w for w in text.lower().split() if w.isalpha() and not any(a == b == c for a, b, c in zip(w, w[1:], w[2:], strict=False))}
        assert plain <= set(restorer.words(text))


def test_character_counts(docs, texts):
    assert (toxicity.character_counts(docs, "text") == sum(trigram_counts(t) for t in texts.values())).all()


def test_trigram_counts_do_not_depend_on_layout():
    assert (trigram_counts("a b") == trigram_counts("A,\n  b")).all()
    assert trigram_counts("").sum() <= 1


def test_curve():
    rng = np.random.default_rng(1)
    points = [(x / 4, hit, int(1000 * (p if hit else 1 - p)) + 1) for x in range(40) for hit in (True, False) for p in [1 / (1 + np.exp(3 - x / 4))]]
    rng.shuffle(points)
    slope, middle = toxicity.logistic([(float(a), bool(b), int(c)) for a, b, c in points])
    assert abs(slope - 1) < 0.1 and abs(middle + 3) < 0.3


def test_held_out_labels(spark):
    """At sf0.1: what the scorer never learnt from."""
    folder = "/root/testdata/sf0.1"
    rows = queries.op7_toxicity(spark, folder).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    tested = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic = [p for p, y in tested if y]
    assert len(tested) > 50 and sum(toxic) >= 0.7 * len(toxic)
    assert sum(p for p, y in tested if not y) <= 0.03 * len(tested)


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 1), (5, 0), (None, 1), (7, None), (8, 0)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    scored = toxicity.score(odd, model, keep=odd.columns, into="_s")
    assert scored.columns == [*odd.columns, "_s"]
    assert all(0 <= r._s <= 1 for r in scored.collect()) and scored.count() == len(ODD)
    empty = toxicity.fit(none, labels.limit(0))
    assert empty.rate == 0 and toxicity.score(odd, empty, keep=["doc_id"]).agg({"score": "max"}).first()[0] == 0


def test_known_tokens_are_not_restored_again(monkeypatch):
    restorer = Restorer(trigram_counts(CORPUS))
    assert restorer.words("happy l0ser, happy") == ["happy", "loser"]
    monkeypatch.setattr(restorer, "token", None)
    assert restorer.words("l0ser, happy") == ["happy", "loser"]


def test_spans_of_single_characters_are_found():
    rng, found = np.random.default_rng(3), 0
    for size in rng.integers(0, 30, 3000):
        text = "".join(rng.choice(list("ab.!(\"\n   "), size))
        spans = list(deobfuscate._SINGLES.finditer(text))
        found += bool(spans)
        assert not spans or deobfuscate._SINGLE.search(text)
    assert found > 100
