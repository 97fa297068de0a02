"""Byte-level BPE by replaying the merges over a whole block of words at once, and back to bytes.

Texts are cut by the vocabulary's pattern. The different words of a block of
documents stand one after the other as bytes; an inverted index files the
positions of every pair of neighbours under the rank of their merge. Merges are
then applied in rank order, each to all its positions at once, and only the
neighbours of what was merged are looked up and filed again. A word that is a
token as it stands is that token, as in the tokenizer library.

Within a word the library always merges the leftmost pair of least rank. Doing
all positions of a rank together gives the same unless a merge makes a pair of
lower rank still; words in which that happens do one position at a time.

Documents are dealt by Spark and stay where they are; a task numbers the words
it has met and replays only new ones, and starts anew beyond ``MOST_WORDS``.

Defined results: a null or empty text has no ids; special strings inside a text
are ordinary text; repeated rows and rows without an id are encoded like any
other; an empty table gives an empty table; other columns are passed on if
named. ``decode`` gives null for null ids and for a row with an id that the vocabulary
does not have.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from ..session import ship_package
from .batches import slices
from .row_keys import unused

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Bytes of text whose words are replayed together.
BLOCK_BYTES = 6_000_000
#: Words a task remembers, about 200 bytes each.
MOST_WORDS = 250_000
#: Characters of a text of which the words are taken at once.
LONG_TEXT = 4_000_000
#: Values of a result batch.
BATCH_IDS = 2_000_000
_SHIFT = 20
_NONE = np.iinfo(np.int64).max


class Vocabulary:
    """Ranks of a byte-level BPE: words, merges by pair, bytes by id."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        pairs, merged = [], []
        for word, rank in ranks.items():
            for cut in range(1, len(word)):
                left, right = ranks.get(word[:cut]), ranks.get(word[cut:])
                if left is not None and right is not None:
                    pairs.append(left << _SHIFT | right)
                    merged.append(rank)
        order = np.argsort(pairs)
        self.pairs = np.append(np.array(pairs, dtype=np.int64)[order], _NONE)
        self.merged = np.append(np.array(merged, dtype=np.int64)[order], _NONE)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        size = max(ranks.values()) + 1
        words = [b""] * size
        for word, rank in ranks.items():
            words[rank] = word
        self.length = np.fromiter(map(len, words), dtype=np.int64, count=size)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(words), dtype=np.uint8)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids, ``_NONE`` where there is none or an id is negative."""
        keys = left << _SHIFT | right
        at = np.searchsorted(self.pairs, keys)
        at[at == len(self.pairs)] = len(self.pairs) - 1
        return np.where((self.pairs[at] == keys) & (left >= 0) & (right >= 0), self.merged[at], _NONE)


@lru_cache(maxsize=2)
def vocabulary(path: str = RANKS) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)})


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, …`` with ``counts[i]`` numbers for each i, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


class Replay:
    """The words of a block while merges are applied to them."""

    def __init__(self, words: Sequence[bytes], vocab: Vocabulary) -> None:
        self.vocab = vocab
        counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        total = int(counts.sum())
        # one more place stands for "no neighbour"; its id is negative
        self.ids = np.append(vocab.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)], -1)
        self.word = np.append(np.repeat(np.arange(len(words)), counts), -1)
        places = np.arange(total)
        same = self.word[1:] == self.word[:-1]
        self.after = np.append(np.where(same, places + 1, total), total)
        self.before = np.append(np.where(np.append(False, same[:-1]), places - 1, total), total) if total else np.array([0])
        self.alive = np.ones(total + 1, dtype=bool)
        self.alive[total] = False
        self.total = total
        self.index: dict[int, list[np.ndarray]] = {}
        self.queue: list[int] = []
        self._file(places)

    def _file(self, places: np.ndarray) -> None:
        """Put pairs that start at ``places`` into the index."""
        ranks = self.vocab.rank(self.ids[places], self.ids[self.after[places]])
        known = ranks != _NONE
        places, ranks = places[known], ranks[known]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        edges = np.flatnonzero(np.diff(ranks, prepend=-1, append=-2)).tolist()
        for a, b in zip(edges, edges[1:], strict=False):
            self._put(int(ranks[a]), places[a:b])

    def _put(self, rank: int, places: np.ndarray) -> None:
        if rank not in self.index:
            self.index[rank] = []
            heapq.heappush(self.queue, rank)
        self.index[rank].append(places)

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each word has."""
        while self.queue:
            rank = heapq.heappop(self.queue)
            found = self.index.pop(rank)
            places = np.sort(np.concatenate(found))
            places = places[np.append(True, places[1:] != places[:-1])]
            self._merge(rank, places)
        left = np.flatnonzero(self.alive)
        return self.ids[left], np.bincount(self.word[left], minlength=int(self.word.max(initial=-1)) + 1)

    def _merge(self, rank: int, places: np.ndarray) -> None:
        # what was filed may be gone by now
        places = places[self.alive[places]]
        places = places[self.vocab.rank(self.ids[places], self.ids[self.after[places]]) == rank]
        if not places.size:
            return
        if places.size > 1:
            # of overlapping pairs every other one, from the left
            linked = np.append(False, self.after[places[:-1]] == places[1:])
            if linked.any():
                at = np.arange(len(places))
                run = at - np.maximum.accumulate(np.where(linked, 0, at))
                places = places[run % 2 == 0]
        second = self.after[places]
        right, left = self.after[second], self.before[places]
        if places.size > 1:
            lower = self._lower(rank, places, left, right)
            if lower.any():
                # these words go on one merge at a time
                of = self.word[places]
                wait = np.isin(of, of[lower]) & np.append(False, of[1:] == of[:-1])
                if wait.any():
                    self._put(rank, places[wait])
                    places, second, right = places[~wait], second[~wait], right[~wait]
        self.ids[places] = rank
        self.alive[second] = False
        self.after[places] = right
        self.before[right] = places
        self.before[self.total] = self.total
        left = self.before[places]
        around = np.append(places, left[left != self.total])
        self._file(around)

    def _lower(self, rank: int, places: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where a merge, done before those to the right of it, makes a pair of lower rank."""
        ids = np.full(len(places), rank)
        beside = np.append(False, self.after[self.after[places[:-1]]] == places[1:])
        lefts = np.where(beside, rank, self.ids[left])
        return (self.vocab.rank(lefts, ids) < rank) | (self.vocab.rank(ids, self.ids[right]) < rank)


def replay(words: Sequence[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after the other, and how many each word has."""
    whole = np.fromiter((vocab.ranks.get(w, -1) for w in words), dtype=np.int64, count=len(words))
    rest = np.flatnonzero(whole < 0)
    ids, counts = Replay([words[i] for i in rest.tolist()], vocab).run()
    every = np.ones(len(words), dtype=np.int64)
    every[rest] = counts
    out = np.empty(int(every.sum()), dtype=np.int64)
    starts = np.cumsum(every) - every
    out[starts[whole >= 0]] = whole[whole >= 0]
    out[_spread(starts[rest], counts)] = ids
    return out, every


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Encoder:
    """Ids of texts; remembers the words it has met."""

    def __init__(self, path: str = RANKS, pattern: str = public_tokenizers.PATTERN, most_words: int = MOST_WORDS) -> None:
        import regex

        self.vocab = vocabulary(path)
        self.pattern = regex.compile(pattern)
        self.most_words = most_words
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.ids = np.empty(0, dtype=np.int64)
        self.starts = self.counts = np.empty(0, dtype=np.int64)

    def _words(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.int32)
        if len(text) <= LONG_TEXT:
            return np.array([*map(self.numbers.__getitem__, self.pattern.findall(text))], dtype=np.int32)
        found, parts = (m.group() for m in self.pattern.finditer(text)), []
        while part := [*map(self.numbers.__getitem__, islice(found, LONG_TEXT // 4))]:
            parts.append(np.array(part, dtype=np.int32))
        return np.concatenate(parts)

    def encode(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if len(self.numbers) > self.most_words:
            self._forget()
        words = [self._words(t) for t in texts]
        new = [w.encode() for w in islice(self.numbers, len(self.starts), None)]
        if new:
            ids, counts = replay(new, self.vocab)
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(counts) - counts)
            self.ids, self.counts = np.append(self.ids, ids), np.append(self.counts, counts)
        for numbers in words:
            yield self.ids[_spread(self.starts[numbers], self.counts[numbers])].astype(np.int32)


def _lists(values: Sequence[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(flat, type=kind.value_type)).cast(kind)


def encode(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), into: str = "ids", path: str = RANKS) -> DataFrame:
    """The columns ``keep`` and the token ids (array of int) of each text."""
    ship_package(docs.sparkSession)
    full = StructType([docs.schema[c] for c in keep if c != into] + [StructField(into, ArrayType(IntegerType(), False))])
    keep = [c for c in keep if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, encoder = to_arrow_schema(full), Encoder(path)

        def done(block: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = encoder.encode([t for b in block for t in b.column(len(keep)).to_pylist()])
            for rows in block:
                at = 0
                while at < rows.num_rows:
                    ids, size = [], 0
                    while at + len(ids) < rows.num_rows and size < BATCH_IDS:
                        ids.append(next(found))
                        size += len(ids[-1])
                    part = rows.slice(at, len(ids))
                    own = _lists(ids, arrow.field(into).type)
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], own], schema=arrow)
                    at += len(ids)

        block, size = [], 0
        for batch in batches:
            for rows in slices(batch):
                block.append(rows)
                size += rows.nbytes
                if size >= BLOCK_BYTES:
                    yield from done(block)
                    block, size = [], 0
        if block:
            yield from done(block)

    return docs.select(*keep, F.col(text).cast("string").alias(unused("_text", keep))).mapInArrow(run, full)


def decode_ids(ids: np.ndarray, vocab: Vocabulary) -> bytes | None:
    """The bytes of token ids; None if one is unknown."""
    if ids.size and (ids.min() < 0 or ids.max() >= len(vocab.length) or not vocab.length[ids].all()):
        return None
    return vocab.bytes[_spread(vocab.start[ids], vocab.length[ids])].tobytes()


def decode(rows: DataFrame, ids: str = "ids", keep: Sequence[str] = ("doc_id",), into: str = "decoded", path: str = RANKS) -> DataFrame:
    """The columns ``keep`` and the bytes (binary) of each row's token ids."""
    ship_package(rows.sparkSession)
    keep = [c for c in keep if c != into]
    full = StructType([rows.schema[c] for c in keep] + [StructField(into, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, vocab = to_arrow_schema(full), vocabulary(path)
        for batch in batches:
            for part in slices(batch):
                lists = part.column(len(keep))
                flat, ends = lists.values.fill_null(-1).to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                there = lists.is_valid().to_numpy(zero_copy_only=False)
                own = [
                    decode_ids(flat[a:b], vocab) if ok else None
                    for a, b, ok in zip(ends, ends[1:], there, strict=False)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], pa.array(own, type=arrow.field(into).type)], schema=arrow
                )

    whole = F.col(ids) if rows.schema[ids].dataType.simpleString() == "array<int>" else F.col(ids).cast("array<long>")
    return rows.select(*keep, whole.alias("_ids")).mapInArrow(run, full)
