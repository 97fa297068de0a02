"""Noisy-channel restoration of disguised words.

What a writer meant is a path through a lattice of characters: a digit or sign
may stand for a letter, a letter written three times or more for one or two of
it, a separator between single letters for nothing. Viterbi decoding finds the
path that is likeliest under a character trigram model and the costs of the
channel. Only spans that show such signs are decoded; other words have one path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np

#: a-z, word border, any other character.
SYMBOLS = 28
BORDER, OTHER = 26, 27
_SYMBOL_OF = {chr(97 + i): i for i in range(26)} | {" ": BORDER}
_BYTES = bytes(b - 97 if 97 <= b <= 122 else OTHER if b >= 128 or 48 <= b <= 57 else BORDER for b in range(256))

# Letters that digits and signs stand for.
LEET = {
    "0": "o",
    "1": "il",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "€": "e",
    "£": "l",
}
SEPARATORS = " .-_*~,/\\"
#: Costs of the channel, in nats: another sign for a letter, a repeated letter, a separator left out.
SIGN, REPEAT, GAP = 1.0, 0.5, 0.3

#: What texts with such spans have in them; found much sooner, as it begins with a given character.
_SINGLE = re.compile(r" \S \S(?=[\s.,;:!?)\"']|\Z)")
_SINGLES = re.compile(r"(?<![^\s(\"'])(?:\S ){2,}\S(?=[\s.,;:!?)\"']|\Z)")
_TRIPLE = re.compile(r"(.)\1\1")
_JOINED = re.compile(r"(?:\w[.\-_*~,/\\]){2,}\w")


def trigram_counts(text: str) -> np.ndarray:
    """Counts of symbol trigrams of a text, as one vector."""
    codes = np.frombuffer(f"  {text.lower()} ".encode("utf-8", "surrogatepass").translate(_BYTES), dtype=np.uint8)
    # runs of borders count as one, so that layout does not matter
    codes = codes[np.concatenate(([True], (codes[1:] != BORDER) | (codes[:-1] != BORDER)))].astype(np.int32)
    codes = np.concatenate(([BORDER], codes))
    at = (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:]
    return np.bincount(at, minlength=SYMBOLS**3)


class Restorer:
    """Decoder with the model of a corpus; remembers what it has decoded."""

    MOST = 100_000

    def __init__(self, counts: np.ndarray) -> None:
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        two = three.sum(axis=0)
        one = two.sum(axis=0)
        base = (one + 1) / (one + 1).sum()
        pair = (two + 5 * base) / (two.sum(axis=1, keepdims=True) + 5)
        full = (three + 5 * pair) / (three.sum(axis=2, keepdims=True) + 5)
        self.cost = -np.log(full)
        self.rows = self.cost.tolist()
        self.known: dict[str, str] = {}
        self.pieces: dict[str, tuple[str, ...]] = {}

    def lattice(self, span: str) -> list[list[tuple[str, float]]]:
        """For each step the strings that may have been meant, with their costs."""
        steps = []
        for char, run in groupby(span):
            size = len(list(run))
            if char.isalpha():
                if size < 3:
                    steps.append([(char * size, 0.0)])
                else:
                    steps.append([(char, REPEAT), (char * 2, 2 * REPEAT)])
            elif char in LEET:
                options = [(letter, SIGN) for letter in LEET[char]] + [(char, 0.0)]
                steps.extend([options] * min(size, 2))
                steps.extend([[(char, 0.0)]] * (size - 2))
            elif char in SEPARATORS:
                steps.append([("", GAP), (" ", 0.0)])
            else:
                steps.append([(" ", 0.0)])
        return steps

    def decode(self, span: str) -> str:
        """The likeliest text behind a span in lower case."""
        # state: last two symbols; value: cost, link to the step before
        beam: dict[tuple[int, int], tuple[float, tuple | None]] = {(BORDER, BORDER): (0.0, None)}
        rows = self.rows
        for options in [*self.lattice(span), [(" ", 0.0)]]:
            following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, link) in beam.items():
                for text, extra in options:
                    x, y, total = a, b, cost + extra
                    for char in text:
                        z = _SYMBOL_OF.get(char, OTHER)
                        if z != BORDER or y != BORDER:
                            total += rows[x][y][z]
                            x, y = y, z
                    if (best := following.get((x, y))) is None or total < best[0]:
                        following[x, y] = (total, (text, link))
            beam = following
        link = min(beam.values(), key=lambda found: found[0])[1]
        parts = []
        while link:
            parts.append(link[0])
            link = link[1]
        return "".join(reversed(parts)).strip()

    def token(self, token: str) -> str:
        """A token in lower case, restored if it shows signs of disguise."""
        if token.isalpha() and not _TRIPLE.search(token):
            return token
        if (known := self.known.get(token)) is not None:
            return known
        core = token.strip(".,;:?\"'()[]{}…").rstrip("!.,;:?\"')]}…")
        letters = sum(map(str.isalpha, core))
        if core.isalpha() and not _TRIPLE.search(core) or not letters:
            found = core
        elif any(c in LEET for c in core) or _TRIPLE.search(core) or _JOINED.search(core):
            found = self.decode(core)
        else:
            found = core
        if len(self.known) >= self.MOST:
            self.known.clear()
        self.known[token] = found
        return found

    def token_words(self, token: str) -> tuple[str, ...]:
        """Words of a restored token in lower case, without punctuation inside them."""
        if (pieces := self.pieces.get(token)) is None:
            if len(self.pieces) >= self.MOST:
                self.pieces.clear()
            pieces = self.pieces[token] = _words(self.token(token))
        return pieces

    def span_words(self, text: str) -> Iterator[str]:
        """Words that single characters of a text in lower case make up."""
        if _SINGLE.search(text):
            for span in _SINGLES.finditer(text):
                yield from _words(self.decode(span[0]))

    def words(self, text: str) -> list[str]:
        """Words of the restored text, each once."""
        text = text.lower()
        out = set(self.span_words(text))
        for token in set(text.split()):
            out.update(self.token_words(token))
        return sorted(out)


_LETTERS = re.compile(r"[^\W\d_]+")


def _words(restored: str) -> tuple[str, ...]:
    if restored.isalpha():
        return (restored,)
    return tuple(w for part in restored.split() for w in ((part,) if part.isalpha() else _LETTERS.findall(part)))
