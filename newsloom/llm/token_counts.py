"""Token counts of texts of any size by overlap resynchronisation.

Texts up to ``HUGE`` bytes are encoded at once. A longer one is encoded in
chunks that overlap; two neighbouring encodings are spliced at a place inside
the overlap where both have a token boundary and which is proven stable: a
space after something that is not a space. No piece of the vocabulary has a
space behind another character (checked when the model is loaded), so no merge
ever crosses such a place and the ids on either side do not depend on the
other. Without such a place the overlap is widened, in the end to the whole
chunk, which is then lengthened.

Defined results: a null or empty text has 0 bytes and 0 tokens; every row is
counted by itself; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import Rows, map_batches
from .tokens import PIECE_BPE, piece_bpe

LIMIT = 4096
#: Bytes of text above which a document is encoded in chunks of that size.
HUGE = 32_768
OVERLAP = 256
_SPACE = "▁"


@lru_cache(maxsize=2)
def splittable(path: str) -> bool:
    """Whether no piece of the model has a space behind another character."""
    model = piece_bpe(path)
    return not any(_SPACE in model.id_to_piece(i).lstrip(_SPACE) for i in range(model.get_piece_size()))


def _stable(data: bytes, at: int) -> bool:
    return data[at] == 0x20 and data[at - 1] != 0x20 and data[at - 3 : at] != _SPACE.encode()


def _character(data: bytes, at: int) -> int:
    """First place from ``at`` backwards where a character begins."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def count_spliced(text: str, model, chunk: int = HUGE, overlap: int = OVERLAP) -> int:
    """Number of tokens of ``text``, encoding at most about ``chunk`` bytes at a time."""
    data = text.encode("utf-8")

    def encode(low: int, high: int) -> list[int]:
        """Places where the tokens of a chunk begin."""
        found = model.encode(data[low:high].decode("utf-8"), return_type="proto")
        return [low + p.begin for p in found.pieces]

    total = start = 0
    end = _character(data, min(chunk, len(data)))
    begins = encode(start, end)
    while end < len(data):
        width, splice = overlap, None
        while splice is None:
            low = max(start, _character(data, end - width))
            high = _character(data, min(end + chunk, len(data)))
            following = encode(low, high)
            both = set(following).intersection(begins[bisect_left(begins, low + 1) :])
            splice = max((at for at in both if at > low and _stable(data, at)), default=None)
            if splice is None and low == start:  # nothing stable in the whole chunk: lengthen it
                break
            width *= 2
        if splice is None:
            chunk, end = 2 * chunk, high
            # from a character before start, as the model puts a space of its own in front of what it is given
            begins = encode(_character(data, start - 1) if start else 0, end)
            begins = begins[bisect_left(begins, start) :]
            continue
        total += bisect_left(begins, splice)
        begins = following[bisect_left(following, splice) :]
        start, end = splice, high
    return total + len(begins)


def count_tokens(
    docs: DataFrame,
    limit: int = LIMIT,
    model_file: str = PIECE_BPE,
    text: str = "text",
    doc_id: str = "doc_id",
    huge: int = HUGE,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""

    def task():
        model = piece_bpe(model_file)
        most = huge if splittable(model_file) else float("inf")

        def work(rows: Rows) -> Rows:
            texts = [t or "" for t in rows["_text"]]
            sizes = [len(t.encode("utf-8")) for t in texts]
            whole = iter(model.encode([t for t, n in zip(texts, sizes, strict=True) if n <= most], num_threads=1))
            counts = [
                len(next(whole)) if n <= most else count_spliced(t, model, huge)
                for t, n in zip(texts, sizes, strict=True)
            ]
            return {"n_bytes": sizes, "n_tokens": counts, "over_limit": [n > limit for n in counts]}

        return work

    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_text"))
    return map_batches(thin, "n_bytes long, n_tokens long, over_limit boolean", task, keep=["doc_id"])
