"""Conversation repair against a search over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import conversation_repair as repair
from newsloom.llm import queries

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def cheapest(rows):
    """(cost, audit, roles) over all edits of (initial, fault) rows; deleting all of them bounds the cost."""
    best = [(2 * len(rows), "D" * len(rows), "")]

    def go(i, cost, audit, roles):
        if cost > best[0][0]:
            return
        if i == len(rows) and GRAMMAR.match(roles):
            best[0] = min(best[0], (cost, audit, roles))
        for r in "ua":
            if cost + 5 <= best[0][0]:
                go(i, cost + 5, audit + "I", roles + r)
        if i == len(rows):
            return
        initial, fault = rows[i]
        go(i + 1, cost + 2, audit + "D", roles)
        if fault in ("blank", "duplicate"):
            return
        more = 5 * (fault == "truncated")
        if initial in tuple("sua"):
            go(i + 1, cost + more, audit + "K", roles + initial)
        for r in "ua":
            go(i + 1, cost + more + 1, audit + "R", roles + r)

    go(0, 0, "", "")
    return best[0]


rows_of = st.lists(
    st.tuples(st.sampled_from("suax"), st.sampled_from(["", "", "", "blank", "duplicate", "truncated"])), max_size=6
)


def solve(rows):
    search = repair.Survivors()
    search.look = 1
    for initial, fault in rows:
        search.step([(a, b, c, e, e) for a, b, c, e in repair.moves(initial, fault)])
        search.look = 1
    cost, rest, ending = search.end()
    return cost, "".join([*search.settled, *rest, ending])


@given(rows_of)
@settings(max_examples=400, deadline=None)
def test_cheapest_edits(rows):
    assert solve(rows) == cheapest(rows)[:2]


def test_memory_holds_only_what_is_open():
    search, most = repair.Survivors(), 0
    for i in range(20_000):
        fault = ("truncated", "", "", "duplicate")[i * i % 7 % 4]
        search.step([(a, b, c, e, e) for a, b, c, e in repair.moves("suax"[i * 5 % 11 % 4], fault)])
        most = max(most, search.open)
    assert most < 200 and len(search.settled) > 19_000


def test_survivors_of_a_conversation_of_blanks_share_their_past():
    search = repair.Survivors()
    for _ in range(1000):
        search.step([(a, b, c, e, e) for a, b, c, e in repair.moves("u", "blank")])
    assert search.open <= 16 and search.end()[0] == 2000


def by_hand(rows):
    """What the query returns, from rows (conv_id, turn, role, text) as they are in the table."""
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        kept[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        kept[conv] += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    out = {}
    for conv, those in kept.items():
        those.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in those:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role[:1], fault))
        turns = [t for t, _, _ in those if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(marked, marked[1:]))
        cost, audit, roles = cheapest(marked) if len(marked) <= 8 else (*solve(marked), None)
        lines, left = [], iter(those)
        place = ""
        for edit in audit:
            if edit == "I":
                place = "a" if place == "u" else "u"
                lines.append(f"{repair.ROLES[place]}:")
                continue
            _, role, text = next(left)
            if edit == "D":
                continue
            if edit == "R":
                role = repair.ROLES["a" if place == "u" else "u"]
            place = role[0]
            lines.append(f"{role}:{text}")
        assert GRAMMAR.match("".join(x[0] for x in lines)) and roles in (None, "".join(x[0] for x in lines))
        faults = [sum(f == x for _, f in marked) for x in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *faults, illegal, cost, audit, digest)
    return out


def found(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("bits", [16, 2])
def test_query(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "SEGMENT_BITS", bits)
    table = pq.read_table(f"{SF}/conversations.parquet").to_pylist()
    got = queries.op12_conversation_repair(spark, SF)
    assert got.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ]
    assert found(got) == by_hand([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table])


SCHEMA = "conv_id long, turn long, role string, text string, pos string, fault string, seg string, audit string, _key string"


def odd_rows(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", None, "", "tool", "User", "aide"]
    texts = [None, "", " \n", "One.", "Two!", "Three", "Why? \t", "One.", "é", "a" * 5000 + "."]
    rows = [
        (rng.choice([1, 2, 3, 4, 5, 6, None]), rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(roles), rng.choice(texts))
        for _ in range(40)
    ]
    return rows + rows[:4]


@pytest.mark.parametrize("bits", [16, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_odd_rows(spark, monkeypatch, seed, bits):
    monkeypatch.setattr(repair, "SEGMENT_BITS", bits)
    rows = odd_rows(seed)
    table = spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)
    assert found(queries.conversation_rows(table)) == by_hand(rows)
    assert queries.conversation_rows(table.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [16, 3])
def test_one_long_conversation(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "SEGMENT_BITS", bits)
    rng = random.Random(5)
    rows = [(7, i, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", "", f"Text {i}."])) for i in range(900)]
    rows += [(8, 0, "user", "Alone."), (6, 3, "system", "Only.")]
    got = found(queries.conversation_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert got == by_hand(rows)


def test_lost_conversations_and_edit_rows(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(lost, 0, "user", "Gone.")]
    empty = hashlib.sha256(b"").hexdigest()
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(queries.conversation_rows(table)) == {lost: (0, 0, 0, 0, 0, 0, "", empty)}
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "")]
    _, edits = repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = [(r.edit, r.turn, r.role, r.text) for r in edits.orderBy("pos", "sub").collect()]
    # another role is cheaper than a row that is missing
    assert got == [("R", 0, "user", "Be kind."), ("K", 1, "assistant", "Hello."), ("D", 2, "assistant", "")]


def test_inserted_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello.")]
    prepared = repair.prepare(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")
    first = prepared.agg({"pos": "min"}).first()[0]
    chosen = spark.createDataFrame([(1, first >> repair.SEGMENT_BITS, first, 0, "KIKII")], "conv_id long, seg long, first long, entry int, audit string")
    got = [(r.edit, r.turn, r.role, r.text) for r in repair.apply(prepared, chosen).orderBy("pos", "sub").collect()]
    ends = [("I", None, "user", ""), ("I", None, "assistant", "")]
    assert got == [("K", 0, "system", "Be kind."), ends[0], ("K", 1, "assistant", "Hello."), *ends]
