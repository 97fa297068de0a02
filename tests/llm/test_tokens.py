"""Packing, id matrices and token counts against the tokenizers themselves."""

import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import best_fit, packing, token_counts
from newsloom.llm.tokens import BYTE_BPE_JSON, PIECE_BPE, byte_bpe, piece_bpe

from .conftest import ODD


@pytest.fixture(scope="module")
def bpe():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BYTE_BPE_JSON)
    return lambda text: [*model.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_rank_form_gives_the_ids_of_the_json_form(bpe, text):
    assert [*byte_bpe()(text).tolist(), 0] == bpe(text)


def test_every_code_point_is_encoded_alike(bpe):
    for low in range(0, 0x110000, 0x800):
        text = "".join(f"a{chr(c)} {chr(c)}1" for c in range(low, low + 0x800) if not 0xD800 <= c < 0xE000)
        assert [*byte_bpe()(text).tolist(), 0] == bpe(text)


def whole(pieces):
    """Pieces lie one behind the other."""
    at = 0
    for start, length in sorted(pieces):
        assert start == at and length > 0
        at += length
    return at


def check_packed(rows, ids_by_crc, capacity=1024):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert all(whole(p) <= capacity for p in by_sequence.values())
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return by_sequence


def test_packing(docs, texts, bpe):
    rows = packing.pack(docs).collect()
    sequences = check_packed(rows, None)
    ids = {d: np.array(bpe(t), dtype="<u4") for d, t in texts.items()}
    parts = defaultdict(list)
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        parts[r.doc_id].append((r.start, r.length))
    assert {d: whole(p) for d, p in parts.items()} == {d: len(i) for d, i in ids.items()}
    assert sum(map(len, ids.values())) > 0.95 * 1024 * len(sequences)


def test_packing_of_odd_rows(odd, none, bpe):
    rows = packing.pack(odd).collect()
    check_packed(rows, None)
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.length
    want = Counter()
    for d, t in ODD:
        want[d] += len(bpe(t))
    assert total == want
    assert packing.pack(none).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=40))
@settings(max_examples=200, deadline=None)
def test_shortest_pack_first_places_every_piece_once(histogram):
    placed, sequences = packing.shortest_pack_first(histogram, 64)
    ranks, used = defaultdict(list), defaultdict(list)
    ends = sorted((p.length, p.first) for p in placed)
    for p in placed:
        following = [f for n, f in ends if n == p.length and f > p.first]
        last = min(following, default=histogram[p.length])
        ranks[p.length] += range(p.first, last)
        for k in range(last - p.first):
            used[p.sequence + k].append((p.offset, p.length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
    assert sorted(used) == list(range(sequences)) and all(whole(u) <= 64 for u in used.values())


def test_longest_first_into_the_shortest_pack():
    placed, sequences = packing.shortest_pack_first({7: 1, 6: 1, 3: 1, 2: 1}, 10)
    assert sequences == 2
    assert [(p.length, p.sequence, p.offset) for p in placed] == [(7, 0, 0), (6, 1, 0), (3, 1, 6), (2, 0, 7)]


def test_matrices_hold_every_id_once(odd, none, bpe):
    rows = best_fit.pack_matrices(odd, capacity=128, pad_id=9, block_ids=2000).collect()
    ids, got = best_fit.matrix([r.ids for r in rows], 128), Counter()
    positions = best_fit.matrix([r.position_ids for r in rows], 128)
    assert len({r.sequence_id for r in rows}) == len(rows)
    for r, row, place in zip(rows, ids, positions, strict=True):
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_ids and (row[r.n_ids :] == 9).all()
        for (a, b), s in zip(pairwise(r.cu_seqlens), r.segments, strict=True):
            assert place[a:b].tolist() == list(range(b - a)) and s.length == b - a
            got[s.doc_id, s.start, tuple(row[a:b].tolist())] += 1
    want = Counter()
    for d, t in ODD:
        full = bpe(t)
        want.update((d, at, tuple(full[at : at + 128])) for at in range(0, len(full), 128))
    assert got == want
    assert best_fit.pack_matrices(none).count() == 0


@given(st.lists(st.integers(1, 50), max_size=60))
@settings(max_examples=200, deadline=None)
def test_best_fit_decreasing(lengths):
    bins = best_fit.best_fit_decreasing(lengths, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    free: list[int] = []
    for index in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = [f for f in free if f >= lengths[index]]
        if room:
            free[free.index(min(room))] -= lengths[index]
        else:
            free.append(50 - lengths[index])
    assert sorted(50 - sum(lengths[i] for i in b) for b in bins) == sorted(free)


def test_token_counts(docs, texts, odd, none):
    model = piece_bpe(PIECE_BPE)
    for r in token_counts.count_tokens(docs, huge=2000).collect():
        assert (r.n_bytes, r.n_tokens) == (len(texts[r.doc_id].encode()), len(model.encode(texts[r.doc_id])))
        assert r.over_limit == (r.n_tokens > 4096)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(odd).collect())
    assert got == Counter((d, len((t or "").encode()), len(model.encode(t or ""))) for d, t in ODD)
    assert token_counts.count_tokens(none).count() == 0


@pytest.mark.parametrize("chunk", [64, 300, 5000])
@pytest.mark.parametrize(
    "text",
    ["a" * 3000, " " * 2000, "é ü " * 900, "x\n" * 1500, "▁ b " * 700, "ab  cd   e " * 300, "日本語" * 400 + " " + "w" * 900],
)
def test_spliced_counts_are_those_of_the_whole_text(text, chunk):
    model = piece_bpe(PIECE_BPE)
    assert token_counts.count_spliced(text, model, chunk, 8) == len(model.encode(text))


@given(st.text(alphabet="ab é▁\n.", min_size=1, max_size=400))
@settings(max_examples=150, deadline=None)
def test_spliced_counts_of_any_text(text):
    model = piece_bpe(PIECE_BPE)
    assert token_counts.count_spliced(text, model, 24, 4) == len(model.encode(text))


def test_model_pieces_never_cross_a_space():
    assert token_counts.splittable(PIECE_BPE) and public_tokenizers.path("piece_bpe_32k.model") == PIECE_BPE


@pytest.mark.parametrize("chunk", [64, 100, 300])
@pytest.mark.parametrize("text", ["hello there world " + "x" * 1000, "hello there " * 20 + "x" * 900, "é ü " * 90 + "日本語" * 400 + " end of it"])
def test_spaceless_run_behind_spaced_text(text, chunk):
    model = piece_bpe(PIECE_BPE)
    assert token_counts.count_spliced(text, model, chunk, 8) == len(model.encode(text))
