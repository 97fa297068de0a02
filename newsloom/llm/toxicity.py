"""Toxicity of documents, scored on text restored by a noisy-channel decoder.

The character model is counted over all documents. The scorer is learnt from
labelled rows: of each word of the restored texts, and of each beginning of a
word, it knows in how many toxic and other documents it stands. A document's
evidence is the sum of its strongest log-odds, and a logistic curve, fitted to
evidence that leaves each document's own counts out, turns it into a score.

Defined results: a null or empty text has no evidence and the score of the
curve at 0; without labels of both kinds every score is the share of toxic
labels, 0 without any; rows with a null label or ``doc_id`` teach nothing, of
repeated labels the highest counts; equal labelled texts are learnt from once;
other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .batches import Rows, map_batches
from .deobfuscate import SYMBOLS, Restorer, trigram_counts
from .row_keys import unused

THRESHOLD = 0.3
#: Labelled rows the scorer is fitted on at most, the first by a hash of their id.
MAX_LABELLED = 200_000
#: Toxic documents a feature must stand in, and its least log-odds.
LEAST_TOXIC, LEAST_WEIGHT = 3, 2.5
#: Lengths of word beginnings that are features.
BEGINNINGS = range(3, 9)
#: Strongest words that make up the evidence.
STRONGEST = 3
_BIN = 0.25


@dataclass(frozen=True)
class Model:
    """Character counts, feature counts (toxic, other), documents of either kind, and the curve."""

    characters: np.ndarray
    features: dict[str, tuple[int, int]]
    toxic: int
    other: int
    curve: tuple[float, float] = (0.0, 0.0)
    rate: float = 0.0

    def weight(self, word: str, own: int | None = None) -> float:
        """Strongest log-odds of a word's features; ``own`` leaves a document of that label out."""
        best = 0.0
        for feature in (f"={word}", *[word[:n] for n in BEGINNINGS if n <= len(word)]):
            if (found := self.features.get(feature)) is not None:
                a, b = found
                a, b = (a - 1, b) if own == 1 else (a, b - 1) if own == 0 else (a, b)
                if a >= LEAST_TOXIC - (own == 1):
                    odds = np.log((a + 0.2) / (self.toxic + 1)) - np.log((b + 0.5) / (self.other + 1))
                    odds *= a / (a + 3)
                    if odds >= LEAST_WEIGHT:
                        best = max(best, float(odds))
        return best

    def score(self, evidence: float) -> float:
        if not self.features:
            return self.rate
        a, b = self.curve
        return float(1 / (1 + np.exp(-(a * evidence + b))))


def evidence(weights: list[float]) -> float:
    return sum(heapq.nlargest(STRONGEST, weights))


def character_counts(docs: DataFrame, text: str) -> np.ndarray:
    """Symbol trigrams of all documents; the table has a fixed number of rows however many there are."""

    def task():
        total = np.zeros(SYMBOLS**3, dtype=np.int64)

        def work(rows: Rows) -> Iterator[Rows]:
            nonlocal total
            if rows:
                total += sum(trigram_counts(t) for t in rows["_text"] if t)
            else:
                used = np.flatnonzero(total)
                yield {"code": used.tolist(), "n": total[used].tolist()}

        return work

    thin = docs.select(F.col(text).cast("string").alias("_text"))
    counted = map_batches(thin, "code int, n long", task, finish=True)
    counts = np.zeros(SYMBOLS**3, dtype=np.int64)
    for row in counted.groupBy("code").agg(F.sum("n").alias("n")).collect():
        counts[row["code"]] = row["n"]
    return counts


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _labelled(
    docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, most: int
) -> DataFrame:
    """Texts with labels to learn from, each text once; bounded by ``most``."""
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.max("label").alias("label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(most)
    texts = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    return texts.join(F.broadcast(known), "_id").groupBy("_text").agg(F.max("label").alias("label"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    max_labelled: int = MAX_LABELLED,
) -> Model:
    """Learn the character model from all documents and the scorer from labelled ones that are not held out."""
    spark = docs.sparkSession
    characters = character_counts(docs, text)
    rows = cut_lineage(_labelled(docs, labels, text, doc_id, label, max_labelled))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = sizes.get(1, 0), sum(n for k, n in sizes.items() if k != 1)
    rate = toxic / (toxic + other) if toxic + other else 0.0
    if not toxic or not other:
        return Model(characters, {}, toxic, other, rate=rate)

    def words():
        restorer = Restorer(characters)
        return lambda read: {"words": [restorer.words(t) for t in read["_text"]]}

    restored = cut_lineage(map_batches(rows, "words array<string>", words, keep=["label"]))
    word = F.explode("words").alias("word")
    features = restored.select("label", word).groupBy("word").agg(
        F.sum((F.col("label") == 1).cast("int")).alias("a"), F.sum((F.col("label") != 1).cast("int")).alias("b")
    )
    # a beginning counts once per document, however many of its words have it
    begins = F.array_distinct(
        F.flatten(
            F.transform(
                "words",
                lambda w: F.transform(
                    F.filter(F.array(*[F.lit(n) for n in BEGINNINGS]), lambda n: n <= F.length(w)),
                    lambda n: F.substring(w, F.lit(1), n),
                ),
            )
        )
    )
    beginnings = restored.select("label", F.explode(begins).alias("word")).groupBy("word").agg(
        F.sum((F.col("label") == 1).cast("int")).alias("a"), F.sum((F.col("label") != 1).cast("int")).alias("b")
    )
    every = features.select(F.concat(F.lit("="), "word").alias("word"), "a", "b").union(beginnings)
    odds = F.log((F.col("a") + 0.2) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (other + 1))
    strong = every.where((F.col("a") >= LEAST_TOXIC) & (odds >= LEAST_WEIGHT / 2))
    # bounded by the words of the labelled rows, which are bounded themselves
    strong = strong.collect()
    model = Model(characters, {r["word"]: (r["a"], r["b"]) for r in strong}, toxic, other, rate=rate)
    sent = spark.sparkContext.broadcast(model)

    def measure():
        known = sent.value
        weights: tuple[dict[str, float], dict[str, float]] = ({}, {})

        def work(read: Rows) -> Rows:
            out = []
            for words, label in zip(read["words"], read["label"], strict=True):
                own = int(label == 1)
                mine = weights[own]
                if len(mine) > Restorer.MOST:
                    mine.clear()
                for word in words:
                    if word not in mine:
                        mine[word] = known.weight(word, own)
                out.append(evidence([mine[w] for w in words]))
            return {"evidence": out}

        return work

    measured = map_batches(restored, "evidence double", measure, keep=["label"], read=["words", "label"])
    bins = (
        measured.groupBy(F.round(F.col("evidence") / _BIN).alias("bin"), (F.col("label") == 1).alias("hit"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    curve = logistic([(r["bin"] * _BIN, r["hit"], r["n"]) for r in bins])
    return Model(characters, model.features, toxic, other, curve, rate)


def logistic(points: list[tuple[float, bool, int]], penalty: float = 0.01) -> tuple[float, float]:
    """Slope and intercept of the likeliest curve through (evidence, label, count), by Newton steps."""
    x = np.array([[p[0], 1.0] for p in points])
    y, n = np.array([float(p[1]) for p in points]), np.array([float(p[2]) for p in points])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - penalty * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + penalty * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def score(
    docs: DataFrame, model: Model, keep: list[str], text: str = "text", into: str = "score"
) -> DataFrame:
    """Columns ``keep`` of ``docs`` with the score of each text, in place of a column named ``into``."""
    keep = [c for c in keep if c != into]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    body = unused(f"{into}_text", keep)

    def task():
        known = sent.value
        restorer = Restorer(known.characters)
        # words of a token that are evidence at all, with their weights; most have none
        weighted: dict[str, dict[str, float]] = {}

        def hits(words: Iterable[str]) -> dict[str, float]:
            return {w: weight for w in words if (weight := known.weight(w))}

        def work(rows: Rows) -> Rows:
            out = []
            for content in rows[body]:
                text, found = (content or "").lower(), {}
                if len(weighted) > Restorer.MOST:
                    weighted.clear()
                for token in set(text.split()):
                    if (some := weighted.get(token)) is None:
                        some = weighted[token] = hits(restorer.token_words(token))
                    if some:
                        found |= some
                found |= hits(restorer.span_words(text))
                out.append(known.score(evidence(list(found.values()))))
            return {into: out}

        return work

    df = docs.select(*keep, F.col(text).cast("string").alias(body))
    return map_batches(df, f"{into} double", task, keep=keep, read=[body])
