"""Packed id matrices: best-fit-decreasing with a segment tree over free capacities.

Each task packs its own documents in blocks of bounded size, so nothing is
shuffled and a lost task is simply run again. Documents longer than a sequence
are split without loss; a piece knows its document and where it began.

Defined results: a null or empty text is the end id alone; repeated rows and
repeated or null ids are documents of their own; an empty table gives no
sequences; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import Rows, map_batches
from .tokens import BYTE_BPE_RANKS, byte_bpe

CAPACITY = 1024
END_ID = 0
#: Ids in a block; it bounds a task's memory, and more leave less room unused.
BLOCK_IDS = 4_000_000


class CapacityTree:
    """Bins by free capacity; finds the least capacity that is enough in O(log capacity)."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, free: int, number: int) -> None:
        self.bins[free].append(number)
        self._change(free, 1)

    def _change(self, free: int, by: int) -> None:
        at = free + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(free capacity, bin) with the least capacity >= ``least``; None if there is none."""
        at, count = least + self.leaves, self.count
        while not count[at]:
            while at & 1:  # a right child: go up
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if count[2 * at] else 2 * at + 1
        free = at - self.leaves
        self._change(free, -1)
        return free, self.bins[free].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of indexes into ``lengths``; ties go to the earlier piece."""
    tree, bins = CapacityTree(capacity), []
    for index in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[index])
        if found is None:
            free, number = capacity, len(bins)
            bins.append([])
        else:
            free, number = found
        bins[number].append(index)
        if free > lengths[index]:
            tree.put(free - lengths[index], number)
    return bins


def pack_matrices(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    pad_id: int = 0,
    vocabulary: str = BYTE_BPE_RANKS,
    text: str = "text",
    doc_id: str = "doc_id",
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """One row per sequence, a row of the id matrix of its block.

    ``sequence_id`` (task, block and row in one number), ``ids`` (``capacity``
    little-endian unsigned 32-bit ids, padded), ``cu_seqlens`` (0, then the end
    of each segment), ``position_ids`` (unsigned 32-bit, from 0 again in each
    segment and in the padding), ``segments`` (doc_id, start in the document's
    ids, length). Write it to any Spark sink; ``matrix`` turns cells into arrays.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def task():
        encode, number = byte_bpe(vocabulary), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4")
        held: list[tuple[object, int, np.ndarray]] = []
        state = {"ids": 0, "next": number << 32}
        ramp = np.arange(capacity, dtype="<u4")

        def block() -> Rows:
            out: Rows = {c: [] for c in ("sequence_id", "n_ids", "ids", "cu_seqlens", "position_ids", "segments")}
            for members in best_fit_decreasing([len(h[2]) for h in held], capacity):
                ends = np.cumsum([len(held[m][2]) for m in members])
                row = np.full(capacity, pad_id, dtype="<u4")
                row[: ends[-1]] = np.concatenate([held[m][2] for m in members])
                starts = [0, *ends.tolist()]
                positions = ramp.copy()
                for at in starts[1:]:
                    positions[at:] = ramp[: capacity - at]
                out["sequence_id"].append(state["next"])
                out["n_ids"].append(starts[-1])
                out["ids"].append(row.tobytes())
                out["cu_seqlens"].append(starts)
                out["position_ids"].append(positions.tobytes())
                out["segments"].append(
                    [{"doc_id": held[m][0], "start": held[m][1], "length": len(held[m][2])} for m in members]
                )
                state["next"] += 1
            held.clear()
            state["ids"] = 0
            return out

        def work(rows: Rows) -> Iterator[Rows]:
            for name, body in zip(rows.get("doc_id", ()), rows.get("_text", ()), strict=True):
                ids = np.concatenate((encode(body), end)).astype("<u4", copy=False) if body else end
                for start in range(0, len(ids), capacity):
                    held.append((name, start, ids[start : start + capacity]))
                state["ids"] += len(ids)
                if state["ids"] >= block_ids:
                    yield block()
            if not rows and held:
                yield block()

        return work

    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_text"))
    schema = (
        "sequence_id long, n_ids long, ids binary, cu_seqlens array<int>, position_ids binary, "
        f"segments array<struct<doc_id: {kind}, start: bigint, length: bigint>>"
    )
    return map_batches(thin, schema, task, finish=True, read=["doc_id", "_text"])


def matrix(cells: list[bytes], capacity: int = CAPACITY) -> np.ndarray:
    """Cells of ``ids`` or ``position_ids`` as the rows of one matrix."""
    return np.frombuffer(b"".join(cells), dtype="<u4").reshape(-1, capacity)
