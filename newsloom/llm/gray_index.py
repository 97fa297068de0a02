"""SimHash near-duplicates with a Gray-order hierarchical index.

Upper nodes of the index are masked bit patterns that fingerprints share: by
the pigeonhole principle two linked fingerprints have one in common (see
``hamming``). Below an upper node the fingerprints are sorted by Gray rank, so
neighbours differ in few bits, and runs of them are factored again into nodes
that hold the bits their members share. A search adds up differing bits on the
way down and leaves a whole node out once they exceed the distance.

Equal fingerprints are one entry of the index. What an index finds is reduced
to classes inside the task, so large groups of near copies give as many rows
as members, not as pairs.

Defined results: a null or empty text, or white space only, has fingerprint
zero and is linked like any other; repeated rows stand beside one another in
one component; a null ``doc_id`` is never the smallest of a component that has
other ids; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_and_measure, cut_lineage
from .batches import Rows, map_batches
from .components import components
from .hamming import Groups, grouped, join_labels
from .row_keys import ID, ROW, from_row, packed, renamed, same_key
from .simhash import shingle_fingerprint, signed

SHINGLE = 4
DISTANCE = 4
#: Fingerprints, or nodes, below one node.
FAN_OUT = 16
#: Queries that descend together.
QUERIES = 256
#: Rows to leave out that are sent to every task; more are joined by key.
DROP_BROADCAST = 100_000


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchy over fingerprints in Gray order; level 0 are the fingerprints themselves."""

    def __init__(self, codes: np.ndarray) -> None:
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.levels: list[tuple[np.ndarray, np.ndarray]] = [
            (codes[self.order], np.full(len(codes), ~np.uint64(0), dtype=np.uint64))
        ]
        while len(self.levels[-1][0]) > FAN_OUT:
            pattern, mask = self.levels[-1]
            starts = np.arange(0, len(pattern), FAN_OUT)
            first = np.repeat(pattern[starts], np.diff(np.append(starts, len(pattern))))
            shared = np.bitwise_and.reduceat(mask & ~(pattern ^ first), starts)
            self.levels.append((pattern[starts] & shared, shared))
        # a node keeps only the bits that its parent does not hold already
        for lower, upper in zip(self.levels, self.levels[1:], strict=False):
            parent = np.arange(len(lower[0])) // FAN_OUT
            lower[1][:] &= ~upper[1][parent]

    def search(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, position of the fingerprint) with at most ``distance`` differing bits."""
        top = len(self.levels[-1][0])
        query = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        differing = np.zeros(len(node), dtype=np.uint8)
        for level in range(len(self.levels) - 1, -1, -1):
            pattern, mask = self.levels[level]
            differing = differing + np.bitwise_count((queries[query] ^ pattern[node]) & mask[node])
            near = differing <= distance
            query, node, differing = query[near], node[near], differing[near]
            if level:
                below = len(self.levels[level - 1][0])
                query = np.repeat(query, FAN_OUT)
                differing = np.repeat(differing, FAN_OUT)
                node = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                if node.size and node.max() >= below:
                    there = node < below
                    query, node, differing = query[there], node[there], differing[there]
        return query, self.order[node]


def classes(codes: np.ndarray, distance: int) -> np.ndarray:
    """For each of the fingerprints of one upper node the first one of its class."""
    labels = np.arange(len(codes))
    if len(codes) <= 4 * FAN_OUT:
        left, right = np.nonzero(np.triu(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= distance, 1))
        return join_labels(labels, left, right)
    index = GrayIndex(codes)
    for at in range(0, len(codes), QUERIES):
        query, found = index.search(codes[at : at + QUERIES], distance)
        labels = join_labels(labels, query + at, found)
    return labels


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and the SimHash of the word shingles as a signed long."""

    def task():
        return lambda rows: {"fingerprint": [signed(shingle_fingerprint(t, shingle)) for t in rows["_text"]]}

    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_text"))
    return map_batches(thin, "fingerprint long", task, keep=["doc_id"], read=["_text"])


def links(distinct: DataFrame, count: int, distance: int = DISTANCE) -> DataFrame:
    """Links (u, v) between distinct fingerprints that connect what is within ``distance``."""

    def task():
        groups = Groups()

        def work(rows: Rows) -> Iterator[Rows]:
            for group in groups.feed(rows):
                codes = group["fingerprint"]
                labels = classes(codes.view(np.uint64), distance)
                linked = np.flatnonzero(labels != np.arange(len(labels)))
                if linked.size:
                    yield {"u": codes[linked].tolist(), "v": codes[labels[linked]].tolist()}

        return work

    near = grouped(distinct.select("fingerprint"), "fingerprint", distance, count)
    return map_batches(near, "u long, v long", task, finish=True, read=["fingerprint", "_group"], arrays=True)


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per document: doc_id, fingerprint (signed long), component_id."""
    marked = cut_lineage(fingerprints(docs, shingle, text, doc_id))
    return marked.join(component_ids(marked, distance), "fingerprint", "left").select(
        "doc_id", "fingerprint", "component_id"
    )


def component_ids(marked: DataFrame, distance: int = DISTANCE, smallest: str = "doc_id") -> DataFrame:
    """(fingerprint, component_id) for every distinct fingerprint of ``marked``; least ``smallest`` of the component."""
    distinct, seen = cut_and_measure(
        marked.groupBy("fingerprint").agg(F.min(smallest).alias("least")), n=F.count(F.lit(1))
    )
    stars = components(links(distinct, seen["n"], distance))
    rooted = distinct.join(stars, distinct["fingerprint"] == stars["u"], "left").select(
        "fingerprint", "least", F.coalesce("v", "fingerprint").alias("root")
    )
    linked = rooted.join(stars.select(F.col("v").alias("root")).distinct(), "root", "left_semi")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root", "left").select(
        "fingerprint", F.coalesce("component_id", "least").alias("component_id")
    )


def keep_one(
    docs: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest ``doc_id`` (null first).

    Rows equal in every column are one document.
    """
    keyed = packed(docs, doc_id, text)
    thin = keyed.select(ID, ROW, "_text")

    def task():
        return lambda rows: {"fingerprint": [signed(shingle_fingerprint(t, shingle)) for t in rows["_text"]]}

    marked = cut_lineage(map_batches(thin, "fingerprint long", task, keep=[ID, ROW], read=["_text"]))
    marked = marked.withColumn("_row", F.struct(ID, ROW))
    kept = component_ids(marked, distance, "_row").withColumnRenamed("component_id", "_kept")
    drop, seen = cut_and_measure(
        marked.join(kept, "fingerprint").where(~F.col("_row").eqNullSafe(F.col("_kept"))).select(ID, ROW).distinct(),
        n=F.count(F.lit(1)),
    )
    drop = renamed(drop)
    left = keyed.join(F.broadcast(drop) if seen["n"] <= DROP_BROADCAST else drop, same_key(), "left_anti")
    if marked.groupBy(ID, ROW).count().where("count > 1").limit(1).count():
        left = left.dropDuplicates([ID, ROW])
    return left.select(from_row(docs.columns))
