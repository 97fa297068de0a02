"""Packing by shortest-pack-first over the histogram of piece lengths.

A document's ids (and an end id) are cut into pieces of at most ``capacity``.
Only the histogram of piece lengths, at most ``capacity`` rows, reaches the
driver. Lengths are placed longest first, each into the packs that are
shortest so far and still have room; packs filled alike are one pattern with a
count and a run of sequence numbers. A piece finds its place from its rank
among the pieces of its length.

A rank is the number of such pieces in earlier tasks plus those before it in
its own task, so no length, however common, is gathered or sorted anywhere.

Defined results: a null or empty text is the end id alone; repeated rows and
repeated or null ids are documents of their own; an empty table has no pieces;
other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .batches import Rows, map_batches
from .tokens import BYTE_BPE_RANKS, byte_bpe

CAPACITY = 1024
END_ID = 0


def pieces(docs: DataFrame, capacity: int, end_id: int, vocabulary: str, text: str, doc_id: str) -> DataFrame:
    """Pieces of all documents with their rank among those of the same length in the same task."""

    def task():
        encode, number = byte_bpe(vocabulary), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        end = np.array([end_id], dtype="<u4")

        def work(rows: Rows) -> Rows:
            out: Rows = {c: [] for c in ("start", "length", "ids_crc32", "doc_tokens", "task", "rank", "_row")}
            for row, body in enumerate(rows["_text"]):
                ids = np.concatenate((encode(body), end)).astype("<u4", copy=False) if body else end
                data, total = ids.tobytes(), len(ids)
                for start in range(0, total, capacity):
                    length = min(capacity, total - start)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(data[4 * start : 4 * (start + length)]))
                    out["doc_tokens"].append(total)
                    out["task"].append(number)
                    out["rank"].append(seen[length])
                    out["_row"].append(row)
                    seen[length] += 1
            return out

        return work

    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_text"))
    schema = "start long, length long, ids_crc32 long, doc_tokens long, task int, rank long"
    return map_batches(thin, schema, task, keep=["doc_id"])


@dataclass(frozen=True)
class Placement:
    """Pieces of one length with ranks from ``first`` on go to sequences from ``sequence`` on, at ``offset``."""

    length: int
    first: int
    sequence: int
    offset: int


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> tuple[list[Placement], int]:
    """Placements for all pieces of a length histogram, and the number of sequences.

    Each length adds at most two patterns (new packs, and what is left of the
    pattern it used last), so there are at most twice as many as lengths.
    """
    packs: list[tuple[int, int, int]] = []  # heap of (length so far, first sequence, count)
    placed: list[Placement] = []
    sequences = 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left and packs and packs[0][0] + length <= capacity:
            so_far, first, count = heapq.heappop(packs)
            used = min(count, left)
            placed.append(Placement(length, rank, first, so_far))
            heapq.heappush(packs, (so_far + length, first, used))
            if used < count:
                heapq.heappush(packs, (so_far, first + used, count - used))
            rank, left = rank + used, left - used
        if left:
            placed.append(Placement(length, rank, sequences, 0))
            heapq.heappush(packs, (length, sequences, left))
            sequences += left
    return placed, sequences


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    vocabulary: str = BYTE_BPE_RANKS,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = cut_lineage(pieces(docs, capacity, end_id, vocabulary, text, doc_id))
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    placed, _ = shortest_pack_first(histogram, capacity)

    ranked = cut.join(per_task, ["length", "task"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("rank")).alias("rank")
    )
    placed.sort(key=lambda p: (p.length, p.first))
    #: one sorted key per placement; its count is bounded by the histogram, not by the documents
    lengths, firsts, sequence, offset = (
        np.array([getattr(p, f) for p in placed], dtype=np.int64) for f in ("length", "first", "sequence", "offset")
    )
    edges = np.searchsorted(lengths, np.arange(capacity + 2))

    def task():
        def work(rows: Rows) -> Rows:
            length, rank = np.array(rows["length"]), np.array(rows["rank"])
            at = np.empty(len(rank), dtype=np.int64)
            for n in np.unique(length):
                low, high, mine = edges[n], edges[n + 1], length == n
                at[mine] = low + np.searchsorted(firsts[low:high], rank[mine], side="right") - 1
            return {"sequence_id": (sequence[at] + rank - firsts[at]).tolist(), "offset": offset[at].tolist()}

        return work

    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return map_batches(ranked, "sequence_id long, offset long", task, keep=keep, read=["length", "rank"])
