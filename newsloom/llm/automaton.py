"""Generalised suffix automaton over word sequences, with matching statistics.

The automaton is built from bounded input (a block of benchmark pieces, a list
of licence templates) and broadcast; texts of any length stream through it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

import numpy as np

_BITS = 20


class SuffixAutomaton:
    """All substrings of several word sequences.

    ``add`` takes one sequence at a time and starts again at the root, so no
    substring spans two sequences. ``stream`` yields, for every position of a
    text, the state and the length of the longest substring that ends there.
    """

    def __init__(self) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        #: sequences whose prefix ends in the state; closed over suffix links by ``close``
        self.owners: list[set[int]] = [set()]
        #: whole sequences that are a suffix of the state: (length, sequence), longest first
        self.whole: list[list[tuple[int, int]]] = []
        self._ends: list[tuple[int, int, int]] = []
        self._pairs: set[tuple[int, int]] = set()
        self.sizes: list[int] = []
        self.shortest = 0
        self._shortlist: np.ndarray | None = None

    def add(self, words: Sequence[bytes]) -> int:
        """Add a sequence of at least one word; returns its number."""
        number, last, before = len(self.sizes), 0, -1
        for word in words:
            symbol = self.vocabulary.setdefault(word, len(self.vocabulary))
            if before >= 0:
                self._pairs.add((before, symbol))
            last, before = self._extend(last, symbol), symbol
            self.owners[last].add(number)
        self._ends.append((last, len(words), number))
        self.sizes.append(len(words))
        return number

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.owners.append(set())
        return len(self.next) - 1

    def _split(self, parent: int, symbol: int, target: int) -> int:
        """State for the part of ``target`` that extends ``parent`` by one word."""
        if self.length[target] == self.length[parent] + 1:
            return target
        copy = self._state(self.length[parent] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while parent >= 0 and self.next[parent].get(symbol) == target:
            self.next[parent][symbol] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        if (there := self.next[last].get(symbol)) is not None:
            return self._split(last, symbol, there)
        new, at = self._state(self.length[last] + 1, 0, {}), last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, symbol, self.next[at][symbol])
        return new

    def close(self, owned_from: int = 1) -> SuffixAutomaton:
        """Hand owners up the suffix links, whole sequences down; call once after the last ``add``.

        Owners are kept for substrings of ``owned_from`` words and more.
        """
        order = np.argsort(self.length, kind="stable").tolist()
        for state in reversed(order):
            if self.length[up := self.link[state]] >= owned_from and up > 0:
                self.owners[up] |= self.owners[state]
        self.whole = [[] for _ in order]
        for state, size, number in self._ends:
            self.whole[state].append((size, number))
        for state in order:
            if self.link[state] > 0:
                self.whole[state] = self.whole[state] + self.whole[self.link[state]]
        self.shortest = min(self.sizes, default=0)
        seen = np.zeros(1 << _BITS, dtype=bool)
        if self._pairs:
            left, right = np.array(sorted(self._pairs), dtype=np.int64).T
            seen[_pair_slot(left, right)] = True
        self._shortlist = seen
        return self

    def runs(self, words: list[bytes], least: int) -> Iterator[tuple[int, list[int]]]:
        """Stretches that may hold a match of ``least`` words: (first position, symbols).

        Any match has only words of the vocabulary and only neighbours that are
        neighbours in some sequence, so what lies outside cannot be part of one.
        """
        if not words or not self.sizes:
            return
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        if least <= 1:
            good = ids >= 0
            extra = 0
        else:
            left, right = ids[:-1], ids[1:]
            good = (left >= 0) & (right >= 0)
            good[good] = self._shortlist[_pair_slot(left[good], right[good])]
            extra = 1
        if not good.any():
            return
        edges = np.flatnonzero(np.diff(np.concatenate(([0], good.view(np.int8), [0]))))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end + extra - start >= least:
                yield start, ids[start : end + extra].tolist()

    def stream(self, symbols: Iterable[int]) -> Iterator[tuple[int, int]]:
        """Matching statistics: (state, length of the longest match that ends here)."""
        state = length = 0
        following, link, lengths = self.next, self.link, self.length
        for symbol in symbols:
            while (to := following[state].get(symbol)) is None and state:
                state = link[state]
                length = lengths[state]
            if to is not None:
                state = to
                length += 1
            yield state, length

    def suffix_state(self, state: int, size: int) -> int:
        """State that holds the last ``size`` words of a longer match ending in ``state``."""
        link, lengths = self.link, self.length
        while lengths[link[state]] >= size:
            state = link[state]
        return state


def _pair_slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left * 0x9E3779B1 + right * 0x85EBCA6B) >> 7 & ((1 << _BITS) - 1)
