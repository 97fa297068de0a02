"""SimHash groups, line deduplication and their parts against plain loops."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import edits, gray_index, hamming, line_dedup, line_sketch, queries
from newsloom.llm.components import components
from newsloom.llm.edits import _within, at_most, levenshtein, similar, similar_pairs
from newsloom.llm.simhash import fingerprint, shingle_fingerprint, signed

from .conftest import ODD

MASK = (1 << 64) - 1


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def simhash_by_bits(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="aB \tcé\n", max_size=80))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert shingle_fingerprint(text, 4) == simhash_by_bits(text)


def test_fingerprint_in_parts(monkeypatch):
    hashes = [xxhash.xxh64_intdigest(str(i)) for i in range(100)]
    whole = fingerprint(hashes, 100)
    monkeypatch.setattr("newsloom.llm.simhash.CHUNK", 7)
    assert fingerprint(hashes, 100) == whole


def near_codes(seed, n):
    """Random codes and copies of earlier ones with a few bits changed."""
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, 1 << 64, 40, dtype=np.uint64).tolist()
    while len(codes) < n:
        code = codes[rng.integers(len(codes))]
        for bit in rng.integers(0, 64, rng.integers(1, 7)):
            code ^= 1 << int(bit)
        codes.append(code)
    return np.unique(np.array(codes, dtype=np.uint64))


def classes_by_hand(codes, distance):
    groups = Union()
    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes[i + 1 :] ^ codes[i]) <= distance).tolist():
            groups.join(i, i + 1 + j)
    return [groups.find(i) for i in range(len(codes))]


def test_gray_ranks_are_those_of_the_reflected_code():
    ranks = np.arange(1000, dtype=np.uint64)
    assert (gray_index.gray_rank(ranks ^ (ranks >> np.uint64(1))) == ranks).all()


@pytest.mark.parametrize("seed", range(5))
def test_index_search_finds_all(seed):
    codes = near_codes(seed, 900)
    query, found = gray_index.GrayIndex(codes).search(codes[:200], 4)
    want = np.argwhere(np.bitwise_count(codes[:200, None] ^ codes[None, :]) <= 4)
    assert sorted(zip(query.tolist(), found.tolist(), strict=True)) == sorted(map(tuple, want.tolist()))
    assert gray_index.classes(codes, 4).tolist() == classes_by_hand(codes, 4)


@given(st.integers(1, 8), st.integers(0, 10**9))
def test_close_codes_share_a_group(distance, rows):
    masks = hamming.block_masks(distance, rows)
    rng = np.random.default_rng(rows)
    for _ in range(30):
        flips = sum(1 << int(b) for b in set(rng.integers(0, 64, distance)))
        assert any(not flips & m for m in masks)


@pytest.mark.parametrize("tile,average", [(3000, 2000), (20, 2000), (50, 1)])
def test_links_over_tiles_and_groups(spark, monkeypatch, tile, average):
    monkeypatch.setattr(hamming, "TILE_ROWS", tile)
    monkeypatch.setattr(hamming, "GROUP_ROWS", average)
    codes = near_codes(11, 1500)
    rows = spark.createDataFrame([(signed(int(c)),) for c in codes], "fingerprint long")
    got = components(gray_index.links(rows, len(codes), 4)).collect()
    labels = classes_by_hand(codes, 4)
    want, mine = Union(), Union()
    for i, label in enumerate(labels):
        want.join(int(codes[i]), int(codes[label]))
    for r in got:
        mine.join(r.u & MASK, r.v & MASK)
    pair = lambda u: Counter(tuple(sorted(x for x in map(int, codes) if u.find(x) == root)) for root in {u.find(int(c)) for c in codes})
    assert pair(mine) == pair(want)


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
@settings(max_examples=5, deadline=None)
def test_components(spark, edges):
    got = {r.u: r.v for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = Union()
    for a, b in edges:
        want.join(a, b)
    assert got == {x: want.find(x) for x in list(want.up) if want.find(x) != x}


def test_near_duplicates(spark, odd, none):
    rows = [(d, t) for d, t in ODD]
    got = Counter((r.doc_id, r.fingerprint & MASK, r.component_id) for r in gray_index.near_duplicates(odd).collect())
    prints = [simhash_by_bits(t) for _, t in rows]
    groups = Union()
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                groups.join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[groups.find(i)] = min(least.get(groups.find(i), d), d)
    assert got == Counter((d, prints[i], least.get(groups.find(i))) for i, (d, _) in enumerate(rows))
    assert gray_index.near_duplicates(none).count() == 0


def test_simhash_query(spark, texts):
    got = queries.op10_simhash(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: r.fingerprint for r in got} == {d: f"{simhash_by_bits(t):016x}" for d, t in texts.items()}
    ids = sorted(texts)
    codes = np.array([simhash_by_bits(texts[d]) for d in ids], dtype=np.uint64)
    assert {r.doc_id: r.component_id for r in got} == {d: ids[k] for d, k in zip(ids, classes_by_hand(codes, 4), strict=True)}


def test_one_of_each_group_stays(odd, none):
    left = gray_index.keep_one(odd)
    assert left.columns == odd.columns
    rows = left.collect()
    prints = Counter(simhash_by_bits(r.text) for r in rows)
    assert max(prints.values()) == 1
    assert {simhash_by_bits(t) for _, t in ODD} == set(prints)
    assert gray_index.keep_one(none).count() == 0


texts_of_words = st.lists(st.sampled_from(["ab", "abc", "b", "cab", "longer", ""]), max_size=12).map(" ".join)


def distance_by_table(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@given(texts_of_words, texts_of_words, st.integers(0, 20), st.sampled_from([0.5, 0.8, 0.95]))
@settings(max_examples=500, deadline=None)
def test_edits(a, b, allowed, least):
    distance = distance_by_table(a, b)
    assert levenshtein(a, b) == distance
    assert not at_most(a, b, allowed) or distance <= allowed
    assert similar(a, b, least) == (distance <= int((1 - least) * max(len(a), len(b)) + 1e-9))


def line_print(line):
    hashes = [xxhash.xxh64_intdigest(w, 42) for w in set(line.split(b" "))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def lines_by_hand(rows):
    """What line deduplication leaves of distinct (doc_id, text) rows, by comparing all lines with all others."""
    groups, where = Union(), {}
    for d, t in rows:
        for pos, line in enumerate((t or "").split("\n")):
            n = line_dedup.normalised(line)
            if len(n.split()) >= 5:
                where.setdefault(n, []).append(((d is not None, d or 0, t), pos))
    known = sorted(where)
    prints = {n: line_print(n) for n in known}
    for i, a in enumerate(known):
        groups.find(a)
        for b in known[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                if 1 - distance_by_table(a.decode(), b.decode()) / max(len(a.decode()), len(b.decode())) >= 0.8:
                    groups.join(a, b)
    best = {}
    for n in known:
        root = groups.find(n)
        first = min((p[0][:2], p[1]) for p in where[n])
        best[root] = min(best.get(root, first), first)
    out = {}
    for d, t in rows:
        lines, gone = (t or "").split("\n"), set()
        for pos, line in enumerate(lines):
            n = line_dedup.normalised(line)
            if n in where and best[groups.find(n)] != ((d is not None, d or 0), pos):
                gone.add(pos)
        left = [line for pos, line in enumerate(lines) if pos not in gone]
        if gone and not any(len(line_dedup.normalised(x).split()) >= 5 for x in left):
            continue
        out[d] = (t if not gone else "\n".join(left), sorted(gone) or None)
    return out


LONG = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
LINES = [
    (1, f"Here is a line, of seven words!\nshort\n{LONG}"),
    (2, f"own words stand in this very line\nHERE is a line of seven words\n{LONG.replace('wordca', 'wordcx')}"),
    (3, "here is a line of seven words\nshort"),
    (4, "a b c d e\na b c d e\nf"),
    (5, None),
    (6, ""),
    (7, f"{LONG} more\nand one line that nobody else has got"),
    (8, "number 1234 is in this line\nnumber 5678 is in this line\nlast of the lines of eight"),
    (None, "a line without an id at all\nHere is a line of seven words"),
]


@pytest.mark.parametrize("tile,fetch", [(3000, 100_000), (10, 0)])
def test_lines(spark, monkeypatch, tile, fetch):
    monkeypatch.setattr(hamming, "TILE_ROWS", tile)
    monkeypatch.setattr(line_dedup, "FETCH_BROADCAST", fetch)
    rows = LINES + [(100 + i, f"family member {LONG} with number{'abcdefghij'[i % 10]}\nmember{i} {'xyz'[i % 3]} b c d") for i in range(30)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.text, r.removed_lines) for r in got} == lines_by_hand(rows)
    assert len(got) == len({r.doc_id for r in got})


def lines_of_rule(rows, similarity=0.8):
    """What is left by the query's rule, linking every two lines that are similar; rows are (doc_id, text), all different."""
    groups, where = Union(), {}
    for d, t in rows:
        for pos, line in enumerate((t or "").split("\n")):
            n = line_dedup.normalised(line, line_dedup._EXACT).decode()
            if len(n.split()) >= 5:
                where.setdefault(n, []).append(((d is not None, d or 0, t), pos))
    known = sorted(where, key=len)
    for i, a in enumerate(known):
        groups.find(a)
        for b in known[i + 1 :]:
            if len(a) < similarity * len(b) - 1:
                break
            if groups.find(a) != groups.find(b) and similar(a, b, similarity):
                groups.join(a, b)
    best = {}
    for n in known:
        root, first = groups.find(n), min((p[0][:2], p[1]) for p in where[n])
        best[root] = min(best.get(root, first), first)
    out, holder = {}, {}
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for line in (t or "").split("\n"):
            holder.setdefault(line.strip(" \t\r\f\v"), d)
    for d, t in rows:
        lines, gone, longer = (t or "").split("\n"), set(), 0
        for pos, line in enumerate(lines):
            n = line_dedup.normalised(line, line_dedup._EXACT).decode()
            longer += n in where
            if n in where and best[groups.find(n)] != ((d is not None, d or 0), pos):
                gone.add(pos)
        left = [line.strip(" \t\r\f\v") for pos, line in enumerate(lines) if pos not in gone]
        if gone and len(gone) == longer and not any(x and holder[x] == d for x in left):
            continue
        out[d] = sorted(gone) or None
    return out


def test_line_query(spark, texts):
    got = {r.doc_id: r.removed_lines for r in queries.op6_line_dedup(spark, "/root/testdata/sf0.001").collect()}
    want = lines_of_rule(list(texts.items()))
    wrong = {d for d in got.keys() | want.keys() if got.get(d, 0) != want.get(d, 0)}
    assert not wrong, {d: (got.get(d, 0), want.get(d, 0)) for d in wrong}


@pytest.mark.parametrize("rows", [2, 1000])
def test_families_of_lines(spark, monkeypatch, rows):
    monkeypatch.setattr(line_dedup, "KEY_ROWS", rows)
    monkeypatch.setattr(line_dedup, "COUNTED", 1)
    monkeypatch.setattr(line_dedup, "COMPARED", rows)
    many = [(i, f"{LONG} with number{'abcdefghij'[i % 10]} {i}\nmember number {i} {'xyz'[i % 3]} of the family of short lines") for i in range(60)]
    many += [(100, "a b c d e\na b c d e\n12 34 56 78 90"), (101, "a b c d e\n12 34 56 78 90\n99 88 77 66 55")]
    docs = spark.createDataFrame(many, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.removed_lines for r in line_dedup.dedup_lines(docs, distance=None).collect()}
    assert got == lines_of_rule(many)


def test_lines_of_odd_rows(odd, none):
    left = line_dedup.dedup_lines(odd, into="_gone")
    assert left.columns == [*odd.columns, "_gone"]
    got = Counter((r.doc_id, r.text) for r in left.collect())
    # rows equal in every column are one document
    want = Counter(set(ODD))
    del want[(5, ODD[4][1])]
    assert got == want
    assert line_dedup.dedup_lines(none).count() == 0


def changed_lines(n, seed):
    """A line of ``n`` words and the same with every tenth word, at least one, of equal length changed."""
    rng = np.random.default_rng(seed)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(n)]
    other = list(words)
    for at in rng.choice(n, max(1, n // 10), replace=False):
        other[at] = other[at][::-1] if other[at] != other[at][::-1] else "zzzzz"
    return " ".join(words), " ".join(other)


def mistyped(line, share, seed):
    """A line with a share of its characters replaced, left out or doubled."""
    rng, out = np.random.default_rng(seed), []
    for c, r in zip(line, rng.random(len(line))):
        out.append(c if r > share else "" if r < share / 3 else chr(97 + int(rng.integers(26))) if r < share * 2 / 3 else c + c)
    return " ".join("".join(out).split())


def found_as_candidates(pairs):
    """Share of pairs that the search would compare."""
    lines = [x.encode() for pair in pairs for x in pair]
    sizes = np.array([len(x) for pair in pairs for x in pair])
    prints, keys, made = line_sketch.sketches(lines, sizes)
    found = 0
    for i in range(0, len(lines), 2):
        one, other = ({k >> line_sketch.SIZE_BITS: k for k in keys[j]} for j in (i, i + 1))
        for gram in set(one) & set(other):
            order = sorted(((one[gram], i), (other[gram], i + 1)))
            block = {"key": np.array([k for k, _ in order]), "print": np.array([prints[j] for _, j in order])}
            block |= {"group": np.zeros(2, dtype=np.int64), "sketch": np.array([made[j].tobytes() for _, j in order], dtype=object)}
            if any(line_dedup.looked_at(block, *p)[0].any() for p in line_dedup.open_pairs(block, 0.8)):
                found += 1
                break
    return found / len(pairs)


@pytest.mark.parametrize("n", [5, 8, 13, 20, 50, 120])
@pytest.mark.parametrize("share,least", [(0, 0.95), (0.05, 0.9), (0.1, 0.5)])
def test_similar_lines_are_candidates(n, share, least):
    pairs = [changed_lines(n, seed) for seed in range(200)]
    if share:
        pairs = [(a, mistyped(a, share, seed)) for seed, (a, _) in enumerate(pairs)]
    pairs = [(a, b) for a, b in pairs if similar(a, b, 0.8)]
    assert len(pairs) > 150 and found_as_candidates(pairs) >= least


@given(st.lists(st.tuples(texts_of_words, texts_of_words), min_size=1, max_size=40), st.sampled_from([0.5, 0.8, 0.95]))
@settings(max_examples=100, deadline=None)
def test_pairs_in_step(pairs, least):
    left, right = [p[0] for p in pairs], [p[1] for p in pairs]
    assert similar_pairs(left, right, least).tolist() == [similar(a, b, least) for a, b in pairs]


@pytest.mark.parametrize("seed", range(6))
def test_long_pairs_in_step(seed):
    rng = np.random.default_rng(seed)
    left = ["".join(rng.choice(list("abcdé "), int(rng.integers(1, 400)))) for _ in range(120)]
    right = [mistyped(a, float(rng.choice([0.1, 0.2, 0.3, 0.6])), i) or "x" for i, a in enumerate(left)]
    allowed = np.array([int(0.2 * max(len(a), len(b))) for a, b in zip(left, right)])
    want = [levenshtein(a, b) <= k for a, b, k in zip(left, right, allowed)]
    assert _within(left, right, allowed).tolist() == want and 10 < sum(want) < 110
    assert similar_pairs(left, right, 0.8).tolist() == [similar(a, b, 0.8) for a, b in zip(left, right)]


def test_query_links_lines_with_a_changed_word(spark, tmp_path):
    texts = [x for n in (5, 8, 20, 50) for x in changed_lines(n, n)]
    assert all(similar(a, b, 0.8) for a, b in zip(texts[::2], texts[1::2], strict=True))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    left = queries.op6_line_dedup(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in left) == [0, 2, 4, 6]


def test_lines_of_other_numbers_stay(spark):
    rows = [
        (1, "12,34,56,78,90\n2024-01-02 10:11:12 the disk is at 17 percent of its whole room"),
        (2, "21,43,65,87,11\n2024-01-02 10:11:13 the disk is at 18 percent of its whole room\n12;34;56;78;90"),
    ]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), distance=None).collect()
    assert {r.doc_id: r.removed_lines for r in got} == {1: None, 2: [1, 2]}


def test_documents_stay_with_short_lines_of_their_own(spark):
    footer = "this footer stands under all of the texts"
    rows = [(1, f"a verse\n{footer}"), (2, f"another verse\n{footer}"), (3, f"a verse\n\n{footer}"), (4, f" \n{footer}")]
    rows += [(5, f"shared\n{footer}"), (6, f"shared\n{footer}")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), distance=None).collect()
    assert {r.doc_id: r.text for r in got} == {1: rows[0][1], 2: "another verse", 5: "shared"}


def test_documents_that_go_are_found_without_their_texts(spark, monkeypatch):
    found, real = [], line_dedup._with_nothing_left
    monkeypatch.setattr(line_dedup, "_with_nothing_left", lambda *tables: found.append(real(*tables)) or found[-1])
    footer = "this footer stands under all of the texts"
    rows = [(1, f"\tshared \r\n***\n{footer}"), (2, f"shared\n\x0b\n{footer}"), (3, f"shared\n***\n {footer}\n"), (4, f"\xa0\n{footer}")]
    rows += [(5, None), (6, f"{footer}\n{footer}"), (7, f"own\n{footer}"), (7, f"own\n{footer}"), (8, f" \n{footer}"), (None, f"***\n{footer}!")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), distance=None).collect()
    left = {None: f"***\n{footer}!", 1: "\tshared \r\n***", 4: "\xa0", 5: None, 7: "own"}
    assert {r.doc_id: r.text for r in got} == left and len(got) == len(left)
    assert "text" not in found[0]._jdf.queryExecution().optimizedPlan().toString()


def test_edit_distance_ends_beyond_its_bound():
    columns = []
    text = type("Text", (str,), {"__iter__": lambda self: (columns.append(c) or c for c in str(self).__str__())})
    one, other = "abc" * 300, text("xyz" * 300)
    assert edits.levenshtein(one, other, 180) > 180
    assert len(columns) < 300
    for most in (2, 3, 4):
        assert (edits.levenshtein("kitten", "sitting", most) <= most) == (most >= 3)
