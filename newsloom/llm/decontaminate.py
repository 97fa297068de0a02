"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items are cut into bounded pieces (overlapping by a window less one word, so no
window is lost), the automaton of a block of pieces is broadcast, and every
document streams its words through it. The length of the longest match ending
at each word tells which windows occur.

Defined results: a null or empty text has no words and no hits; an item without
words has no windows; repeated items count once per ``item_id``; a null
``item_id`` counts as the empty string; an empty items table hits nothing;
other columns of either table are ignored or passed through unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_and_measure, cut_lineage
from .automaton import SuffixAutomaton
from .batches import Rows, map_batches
from .row_keys import DOC, as_row, from_row, unused
from .words import word_bytes, word_spans

WINDOW = 10
#: Words of benchmark items in one automaton, and so in one broadcast (some tens of MB).
BLOCK_WORDS = 100_000
#: Words of one piece of a long item.
PIECE_WORDS = 5_000
#: Contaminated spans of at least this many words are cut from a text ...
MAX_SPAN = 1
#: ... and a text of which more than this share is contaminated is dropped.
MAX_COVERAGE = 0.5

Span = tuple[int, int]


def _pieces(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    def task():
        def work(rows: Rows) -> Rows:
            out: Rows = {"item": [], "words": [], "size": []}
            for item, body in zip(rows["item"], rows["text"], strict=True):
                words = word_bytes(body)
                for at in range(0, max(len(words) - window + 1, 1), PIECE_WORDS):
                    if part := words[at : at + PIECE_WORDS + window - 1]:
                        out["item"].append(item)
                        out["words"].append(b" ".join(part).decode("utf-8", "surrogatepass"))
                        out["size"].append(len(part))
            return out

        return work

    thin = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).cast("string").alias("text")
    )
    return map_batches(thin, "item string, words string, size long", task).distinct()


def _block_count(pieces: DataFrame) -> int:
    return max(1, math.ceil((pieces.agg(F.sum("size")).first()[0] or 0) / BLOCK_WORDS))


def _blocks(pieces: DataFrame, window: int) -> Iterator[tuple[SuffixAutomaton, list[str]]]:
    """Lazily one automaton per block; a block has about ``BLOCK_WORDS`` words, so it can be collected."""
    count = _block_count(pieces)
    for block in range(count):
        mine = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(count)) == block)
        automaton, names = SuffixAutomaton(), []
        for row in sorted(mine.select("item", "words").collect()):
            automaton.add(row["words"].encode("utf-8", "surrogatepass").split())
            names.append(row["item"])
        yield automaton.close(window), names


def hits(words: list[bytes], automaton: SuffixAutomaton, names: list[str], window: int) -> tuple[list[Span], set[str]]:
    """Merged spans of hit words, and the items whose windows occur."""
    spans: list[Span] = []
    found: set[str] = set()
    owned: set[int] = set()
    short = automaton.shortest < window
    least = min(window, automaton.shortest)
    for start, symbols in automaton.runs(words, least):
        for end, (state, length) in enumerate(automaton.stream(symbols), start + 1):
            hit = 0
            if length >= window:
                hit = window
                if (here := automaton.suffix_state(state, window)) not in owned:
                    owned.add(here)
                    found.update(names[n] for n in automaton.owners[here])
            if short and length >= least:
                for size, number in automaton.whole[state]:
                    if size <= length and size < window:
                        hit = max(hit, size)
                        found.add(names[number])
            if hit:
                spans.append((end - hit, end))
    return merged(spans), found


def annotate(
    docs: DataFrame,
    items: DataFrame,
    keep: Sequence[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    into: str = "leak",
) -> DataFrame:
    """Columns ``keep`` of ``docs`` with a struct ``into``: n_words, spans of hit words, items.

    One pass over the documents per block of the benchmark; with more than one
    block each pass is written, so that a lost executor repeats one pass only.
    ``into`` takes the place of a column of that name.
    """
    keep = [c for c in keep if c != into]
    pieces = cut_lineage(_pieces(items, item_id, item_text, window))
    df = docs.select(
        as_row(keep).alias(DOC), F.col(f"`{text}`").cast("string").alias(_BODY), F.lit(None).cast(_KIND).alias(_FOUND)
    )
    blocks = _blocks(pieces, window)
    block = next(blocks)
    while block:
        sent = docs.sparkSession.sparkContext.broadcast(block)
        block = next(blocks, None)
        df = map_batches(
            df, f"_leak_now {_KIND}", _scan(sent, window), keep=[DOC, _BODY] if block else [DOC], read=[_BODY, _FOUND]
        ).withColumnRenamed("_leak_now", _FOUND)
        if block:
            df = cut_lineage(df)
    return df.select(*from_row(keep), F.col(_FOUND).alias(into))


_KIND = "struct<n_words: bigint, spans: array<struct<first: bigint, last: bigint>>, items: array<string>>"
_BODY, _FOUND = "_leak_text", "_leak_found"


def _scan(sent, window: int):
    def task():
        automaton, names = sent.value

        def work(rows: Rows) -> Rows:
            out = []
            for body, earlier in zip(rows[_BODY], rows[_FOUND], strict=True):
                words = word_bytes(body)
                spans, found = hits(words, automaton, names, window)
                if earlier:
                    spans = merged(spans + [(s["first"], s["last"]) for s in earlier["spans"]])
                    found |= set(earlier["items"])
                out.append(
                    {
                        "n_words": len(words),
                        "spans": [{"first": a, "last": b} for a, b in spans],
                        "items": sorted(found),
                    }
                )
            return {"_leak_now": out}

        return work

    return task


def merged(spans: list[Span]) -> list[Span]:
    """Union of spans, in order."""
    out: list[Span] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut(text: str, spans: list[Span]) -> str:
    """``text`` without the words of the spans and what stands between them."""
    offsets = word_spans(text)
    out, at = [], 0
    for first, last in spans:
        out.append(text[at : offsets[first][0]])
        at = offsets[last - 1][1]
    return "".join(out) + text[at:]


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_span: int = MAX_SPAN,
    max_coverage: float = MAX_COVERAGE,
) -> DataFrame:
    """``docs`` without the passages of ``items``, same columns.

    Spans of ``max_span`` hit words and more are cut out of a text; a document
    of which more than ``max_coverage`` of the words are hit is left out. Where
    a cut brings new neighbours together, they are looked at again, until no
    window is left. Documents without hits come back unchanged.
    """
    others = [c for c in docs.columns if c != text]
    schema = StructType([docs.schema[text]])
    pieces = cut_lineage(_pieces(items, item_id, item_text, window))
    if _block_count(pieces) == 1:
        sent = docs.sparkSession.sparkContext.broadcast(next(_blocks(pieces, window)))
        work = _clean(sent, text, window, max_span, max_coverage)
        return map_batches(docs, schema, work, keep=others).select(docs.columns)
    df, first, leak = docs, True, unused("_leak", docs.columns)
    while True:
        long_spans = F.filter(F.col(leak)["spans"], lambda s: s["last"] - s["first"] >= max_span)
        found = annotate(df, items, docs.columns, text, item_id, item_text, window, leak)
        found, seen = cut_and_measure(found, hit=F.count(F.when(F.size(long_spans) > 0, 1)))
        if not seen["hit"]:
            return found.select(docs.columns)
        work = _cut_found(text, leak, max_span, max_coverage if first else 1.0)
        df, first = map_batches(found, schema, work, keep=others, read=[text, leak]).select(docs.columns), False


def _cut_found(text: str, leak_name: str, max_span: int, max_coverage: float):
    def task():
        def work(rows: Rows) -> Rows:
            out: Rows = {text: [], "_row": []}
            for number, (body, leak) in enumerate(zip(rows[text], rows[leak_name], strict=True)):
                spans = [(s["first"], s["last"]) for s in leak["spans"]]
                if sum(b - a for a, b in spans) > max_coverage * leak["n_words"]:
                    continue
                spans = [(a, b) for a, b in spans if b - a >= max_span]
                out[text].append(cut(body, spans) if spans else body)
                out["_row"].append(number)
            return out

        return work

    return task


def _clean(sent, text: str, window: int, max_span: int, max_coverage: float):
    def task():
        automaton, names = sent.value

        def work(rows: Rows) -> Rows:
            out: Rows = {text: [], "_row": []}
            for number, body in enumerate(rows[text]):
                spans, _ = hits(words := word_bytes(body), automaton, names, window)
                if sum(b - a for a, b in spans) > max_coverage * len(words):
                    continue
                while spans := [(a, b) for a, b in spans if b - a >= max_span]:
                    body = cut(body, spans)
                    spans, _ = hits(word_bytes(body), automaton, names, window)
                out[text].append(body)
                out["_row"].append(number)
            return out

        return work

    return task
