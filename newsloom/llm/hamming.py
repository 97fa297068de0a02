"""Shared parts of the operators that link 64-bit fingerprints by Hamming distance.

Two fingerprints with at most ``k`` differing bits, cut into ``b > k`` blocks of
bits, agree on at least ``b - k`` blocks. So every link lies inside some group
of fingerprints that share the bits of one choice of ``b - k`` blocks. A group
with many rows is cut into tiles, and each pair of tiles is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Rows a group should have on average, from which the number of blocks follows.
GROUP_ROWS = 2_000
#: Rows of one tile; a group of more rows is cut into tiles.
TILE_ROWS = 3_000
#: Low bits of a group's key, which tell the choice of blocks.
_CHOICE = (1 << 10) - 1
#: Hot groups that are sent to every task; more are joined by key.
HOT_BROADCAST = 10_000
MAX_BLOCKS = 12


def block_masks(distance: int, rows: int) -> list[int]:
    """Masks of the shared bits, few and short for few rows, more and longer for more."""
    for blocks in range(distance + 1, MAX_BLOCKS + 1):
        if rows >> (64 * (blocks - distance) // blocks) <= GROUP_ROWS:
            break
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - distance)]
    assert len(masks) == comb(blocks, distance)
    return masks


def _long(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def grouped(rows: DataFrame, fingerprint: str, distance: int, count: int, order: Column | None = None) -> DataFrame:
    """``rows`` once per group (column ``_group``) and tile pair they belong to, together and in order.

    ``rows`` has about one row per fingerprint. Which rows of a partition form
    a group is told by equal ``_group``, ``_left`` and ``_right``.
    """
    masks = block_masks(distance, count)
    low, high = F.lit(_CHOICE).cast("long"), F.lit(~_CHOICE).cast("long")
    nodes = F.array(
        *[
            F.xxhash64(F.lit(i), F.col(fingerprint).bitwiseAND(_long(m))).bitwiseAND(high).bitwiseOR(F.lit(i).cast("long"))
            for i, m in enumerate(masks)
        ]
    )
    spread = rows.withColumn("_group", F.explode(nodes))
    sizes = rows.select(F.explode(nodes).alias("_group")).groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    spread = tiled(spread, sizes, fingerprint)
    key = F.xxhash64("_group", "_left", "_right").bitwiseAND(high).bitwiseOR(F.col("_group").bitwiseAND(low))
    spread = spread.select(*rows.columns, key.alias("_group"))
    return spread.repartition("_group").sortWithinPartitions(
        "_group", *([order] if order is not None else []), fingerprint
    )


def tiled(spread: DataFrame, sizes: DataFrame, by: str, tile_rows: int | None = None) -> DataFrame:
    """``spread`` with the tiles ``_left`` and ``_right`` of each row, one row per tile pair in hot groups."""
    tile_rows = tile_rows or TILE_ROWS
    names = [c for c in spread.columns if c != "_group"]
    hot = cut_lineage(
        sizes.where(F.col("_n") > tile_rows).select("_group", F.ceil(F.col("_n") / F.lit(tile_rows)).alias("_tiles"))
    )
    found = hot.count()
    if not found:
        return spread.withColumns({"_left": F.lit(0), "_right": F.lit(0)})
    spread = spread.join(F.broadcast(hot) if found <= HOT_BROADCAST else hot, "_group", "left")
    tiles = F.coalesce(F.col("_tiles"), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(by, F.lit("tile")), tiles).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), tiles - 1), lambda t: F.struct(F.least(t, own).alias("l"), F.greatest(t, own).alias("r"))
    )
    return spread.withColumn("_cell", F.explode(cells)).select(
        *names, "_group", F.col("_cell.l").alias("_left"), F.col("_cell.r").alias("_right")
    )


def near_pairs(codes: np.ndarray, distance: int, key: int, masks: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a group within ``distance``, in parts; each pair in the first of the groups that both are in."""
    earlier = np.array(masks[: key & _CHOICE], dtype=np.uint64)
    for at in range(0, len(codes), 256):
        near = np.bitwise_count(codes[at : at + 256, None] ^ codes[None, at:]) <= distance
        left, right = np.nonzero(near)
        later = right > left
        left, right = left[later] + at, right[later] + at
        if left.size and earlier.size:
            differ = (codes[left] ^ codes[right])[:, None] & earlier
            first = (differ != 0).all(axis=1)
            left, right = left[first], right[first]
        if left.size:
            yield left, right


class Groups:
    """Cuts a stream of sorted columns (arrays) into groups, over the borders of batches."""

    def __init__(self) -> None:
        self.held: list[dict[str, np.ndarray]] = []

    def feed(self, columns: dict[str, np.ndarray]) -> Iterator[dict[str, np.ndarray]]:
        """Complete groups of at least two rows among what was fed so far; feed no columns at the end."""
        if columns:
            self.held.append(columns)
            if columns["_group"][-1] == self.held[0]["_group"][0]:
                return
        if not self.held:
            return
        whole = {n: np.concatenate([h[n] for h in self.held]) for n in self.held[0]}
        keys = whole["_group"]
        end = int(np.searchsorted(keys, keys[-1])) if columns else len(keys)
        self.held = [{n: v[end:] for n, v in whole.items()}] if columns else []
        edges = [0, *(np.flatnonzero(np.diff(keys[:end])) + 1).tolist(), end]
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a > 1:
                yield {n: v[a:b] for n, v in whole.items()}


def join_labels(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels (each the least member of its class) after linking ``left`` with ``right``."""
    while True:
        a, b = labels[left], labels[right]
        differ = a != b
        if not differ.any():
            return labels
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(labels, up := labels[labels]):
            labels = up
