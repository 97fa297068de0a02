"""SimHash of hashed features, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import xxhash

SEED = 42
#: Features counted at once, so that a text of any length needs bounded memory.
CHUNK = 65_536


def fingerprint(hashes: Iterable[int], count: int) -> int:
    """Bits that are set in over half of ``count`` unsigned 64-bit hashes; 0 for none."""
    if not count:
        return 0
    ones, hashes = np.zeros(64, dtype=np.int64), iter(hashes)
    for at in range(0, count, CHUNK):
        part = np.fromiter(islice(hashes, min(CHUNK, count - at)), dtype=">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def shingles(words: list[bytes], size: int) -> Iterator[bytes]:
    """Runs of ``size`` words with single spaces; fewer words give the whole sequence once."""
    if len(words) <= size:
        return iter([b" ".join(words)] if words else [])
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = [0, *ends[: len(words) - size].tolist()]
    return map(joined.__getitem__, map(slice, starts, (ends[size - 1 :] - 1).tolist()))


def shingle_fingerprint(text: str | None, size: int) -> int:
    """SimHash of the word shingles of a text; words are separated by ASCII white space, A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    count = max(len(words) - size + 1, min(len(words), 1))
    return fingerprint(map(xxhash.xxh64_intdigest, shingles(words, size), repeat(SEED)), count)


def signed(value: int) -> int:
    """The same 64 bits as Spark's long."""
    return value - (1 << 64) if value >> 63 else value
