"""Conversation structure repair: the cheapest edits after which roles alternate.

A conversation is repaired when the first letters of its roles read
``(s?(ua)+)?``. Rows may be kept, given the other role, deleted, and rows
without text may be inserted, see ``moves``. A Viterbi search over the four
places in that grammar finds the cheapest edits, of several the one whose
initials come first. Its survivors are leaves of a tree of backpointers that
counts references: branches that no survivor needs are freed, and edits are
given out as soon as all survivors share them, so memory holds only what is
still open. Equal costs are settled by comparing all that is still open. A place is
given up once another one could take its part for less (``INSTEAD``); else a
conversation that might still be deleted whole would keep everything open.

Rows are sorted over the whole table and cut into segments, so a conversation
may be spread over any number of tasks: a segment that does not hold a whole
conversation is solved from each place it may be entered at, and a second
search over segments, which needs a few numbers of each, joins them.

Defined results: rows stand in order of turn (null first), role, text; a null
``conv_id`` is one conversation; null roles and texts count as one space; a
role without a letter, or with another than s, u, a, cannot be kept; repeated
rows are duplicates of one another; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import HOT_MIN_ROWS, lookup_join
from ..session import cut_and_measure, cut_lineage
from .batches import Rows, map_batches

#: Rows of a segment, as a power of two.
SEGMENT_BITS = 16
RETAG, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Places in the grammar: nothing yet, behind the system row, behind a user's, behind an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"u": "user", "a": "assistant"}
FAULTS = ("", "blank", "duplicate", "truncated")
#: What a complete conversation may still need at its end.
ENDINGS = {START: (0, ""), ASSISTANT: (0, ""), USER: (INSERT, "I"), SYSTEM: (2 * INSERT, "II")}
#: What it costs at most to go on from one place as if from another; a place that is dearer than that by more is given up.
INSTEAD = {
    START: {SYSTEM: 0, USER: INSERT, ASSISTANT: 0},
    SYSTEM: {START: 2 * INSERT, USER: INSERT, ASSISTANT: 2 * INSERT},
    USER: {START: INSERT + DELETE, SYSTEM: INSERT, ASSISTANT: INSERT},
    ASSISTANT: {START: DELETE, SYSTEM: 0, USER: INSERT},
}
_INSTEAD_OF = {at: [(other, more[at]) for other, more in INSTEAD.items() if other != at] for at in INSTEAD}
_SPACE = " \t\n\x0b\x0c\r"


@lru_cache(maxsize=64)
def moves(initial: str, fault: str) -> tuple[tuple[int, int, int, str], ...]:
    """(from, to, cost, edits) that a row allows; rows are inserted in front of one that stays."""
    out = [(at, at, DELETE, "D") for at in (START, SYSTEM, USER, ASSISTANT)]
    if fault in ("blank", "duplicate"):
        return tuple(out)
    cost = TRUNCATED if fault == "truncated" else 0
    if initial == "s":
        out.append((START, SYSTEM, cost, "K"))
    for at in (START, SYSTEM, USER, ASSISTANT):
        role, to = ("a", ASSISTANT) if at == USER else ("u", USER)
        out.append((at, to, cost, "K") if initial == role else (at, to, cost + RETAG, "R"))
        role, to = ("u", USER) if at == USER else ("a", ASSISTANT)
        more = cost + INSERT
        out.append((at, to, more, "IK") if initial == role else (at, to, more + RETAG, "IR"))
    return tuple(out)


class _Node:
    __slots__ = ("key", "parent", "refs", "value")

    def __init__(self, parent: _Node | None, key, value) -> None:
        self.parent, self.key, self.value, self.refs = parent, key, value, 1


class Survivors:
    """The best way to each place, as leaves of one tree.

    Steps carry a ``key``, by which ways of equal cost are ordered, and a
    ``value``, which is given out.
    """

    def __init__(self, place: int = START, give: Callable[[object], None] | None = None) -> None:
        self.root = _Node(None, None, None)
        self.alive: dict[int, tuple[int, _Node]] = {place: (0, self.root)}
        self.settled: list = []
        self.give = give or self.settled.append
        self.open = 0
        self.look = 16

    @staticmethod
    def _before(left: _Node, left_key, right: _Node, right_key) -> bool:
        """Whether one way comes before another one of as many steps; walks back to where they part."""
        less = left_key < right_key
        while left is not right:
            if left.key != right.key:
                less = left.key < right.key
            left, right = left.parent, right.parent
        return less

    def step(self, options: Iterable[tuple]) -> None:
        """Go on by one of the options (from, to, cost, key, value)."""
        best: dict[int, tuple] = {}
        for source, target, cost, key, value in options:
            if source not in self.alive:
                continue
            spent, node = self.alive[source]
            old = best.get(target)
            if (
                old is None
                or spent + cost < old[0]
                or spent + cost == old[0]
                and self._before(node, key, old[1], old[2])
            ):
                best[target] = (spent + cost, node, key, value)
        new = {}
        for target, (spent, parent, key, value) in best.items():
            if any(best[other][0] + more < spent for other, more in _INSTEAD_OF[target] if other in best):
                continue
            parent.refs += 1
            new[target] = (spent, _Node(parent, key, value))
        for _, node in self.alive.values():
            self._release(node)
        self.alive = new
        self.open += 1
        if self.open >= self.look:
            self._settle()
            self.look = max(16, 2 * self.open)

    @staticmethod
    def _release(node: _Node | None) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            node = node.parent

    def _way(self, node: _Node) -> list[_Node]:
        way = []
        while node is not self.root:
            way.append(node)
            node = node.parent
        return way[::-1]

    def _settle(self) -> None:
        """Give out what all survivors share."""
        for node in self._way(next(iter(self.alive.values()))[1]):
            if self.root.refs != 1:
                return
            self.give(node.value)
            node.parent = None
            self.root = node
            self.open -= 1

    def ways(self) -> dict[int, tuple[int, list]]:
        """Cost and remaining values of the best way to each place."""
        return {at: (cost, [n.value for n in self._way(node)]) for at, (cost, node) in self.alive.items()}

    def end(self) -> tuple[int, list, str]:
        """Cost, remaining values and ending of the best complete way."""
        best = None
        for at, (cost, node) in self.alive.items():
            more, ending = ENDINGS[at]
            if (
                best is None
                or cost + more < best[0]
                or cost + more == best[0]
                and self._before(node, ending, best[1], best[2])
            ):
                best = (cost + more, node, ending)
        cost, node, ending = best
        return cost, [n.value for n in self._way(node)], ending


class _Segment:
    """Rows of one conversation in one segment."""

    def __init__(self, conv_id, seg: int, first: int, entries: tuple[int, ...]) -> None:
        self.conv_id, self.seg, self.first = conv_id, seg, first
        self.searches = {at: Survivors(at) for at in entries}
        self.illegal, self.head, self.tail = 0, None, None

    def add(self, initial: str, fault: str) -> None:
        if self.head is None:
            self.head = initial
        elif f"{self.tail}{initial}" not in ("su", "ua", "au"):
            self.illegal += 1
        self.tail = initial
        options = [(a, b, cost, edits, edits) for a, b, cost, edits in moves(initial, fault)]
        for search in self.searches.values():
            search.step(options)

    def solved(self, whole: bool) -> dict:
        found = []
        for entry, search in self.searches.items():
            if whole:
                cost, rest, ending = search.end()
                found.append((entry, -1, cost, "".join([*search.settled, *rest, ending])))
            else:
                for at, (cost, rest) in search.ways().items():
                    found.append((entry, at, cost, "".join([*search.settled, *rest])))
        order = {audit: i for i, audit in enumerate(sorted({f[3] for f in found}))}
        return {
            "conv_id": self.conv_id,
            "seg": self.seg,
            "first": self.first,
            "whole": whole,
            "illegal": self.illegal,
            "head": self.head,
            "tail": self.tail,
            "ways": [{"entry": e, "exit": x, "cost": c, "place": order[a], "audit": a} for e, x, c, a in found],
        }


_WAYS = "array<struct<entry int, exit int, cost long, place int, audit string>>"


def _columns(rows: list[dict], names: Iterable[str]) -> Rows:
    return {n: [r[n] for r in rows] for n in names}


def prepare(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, turn, role, text, ``pos`` (place in the order of the whole table) and ``fault``, as a written table."""
    named = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    # rows equal in all four have no order, but need not meet in one task
    order = ["conv_id", "turn", "role", "text", "_tie"]
    named = named.withColumn("_tie", F.monotonically_increasing_id())
    end = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    whole_text = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.length("role"), "role", "text")
    ordered, seen = cut_and_measure(
        named.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_tie")
        .withColumns(
            {
                "pos": F.monotonically_increasing_id(),
                "_end": end,
                "_key": F.when(end != "", F.sha2(F.concat(F.col("conv_id").isNull().cast("string"), whole_text), 256)),
            }
        ),
        n=F.count(F.lit(1)),
    )
    first = ordered.where("_key is not null").groupBy("_key").agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = first.where("_n > 1").drop("_n")
    fault = (
        F.when(F.col("_end") == "", "blank")
        .when(F.col("_first") < F.col("pos"), "duplicate")
        .when(~F.col("_end").isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    found = lookup_join(ordered, first, "_key", "pos", seen["n"], min_rows=HOT_MIN_ROWS)
    return cut_lineage(found.select("conv_id", "turn", "role", "text", "pos", fault.alias("fault")))


def _seg() -> Column:
    return F.shiftright("pos", SEGMENT_BITS)


def segments(prepared: DataFrame) -> DataFrame:
    """One row per conversation and segment with its best ways."""
    names = ["conv_id", "seg", "first", "whole", "illegal", "head", "tail", "ways"]

    def task():
        held: list[_Segment] = []

        def close(last: bool) -> Iterator[dict]:
            if held:
                # whatever begins behind another conversation and ends before one is complete
                yield held[0].solved(whole=not last and START in held[0].searches and len(held[0].searches) == 1)
                held.clear()

        def work(rows: Rows) -> Rows:
            out: list[dict] = []
            if not rows:
                out += close(True)
                return _columns(out, names)
            for conv_id, pos, initial, fault in zip(rows["conv_id"], rows["pos"], rows["initial"], rows["fault"], strict=True):
                seg = pos >> SEGMENT_BITS
                now = held[0] if held else None
                if now is None or now.seg != seg or now.conv_id != conv_id:
                    begins = now is None or now.seg != seg
                    out += close(begins)
                    held.append(_Segment(conv_id, seg, pos, (START, SYSTEM, USER, ASSISTANT) if begins else (START,)))
                held[0].add(initial, fault)
            return _columns(out, names)

        return work

    thin = prepared.select("conv_id", "pos", F.left("role", F.lit(1)).alias("initial"), "fault")
    thin = thin.repartition(_seg()).sortWithinPartitions("pos")
    kind = prepared.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, seg long, first long, whole boolean, illegal long, head string, tail string, ways {_WAYS}"
    return map_batches(thin, schema, task, finish=True, read=["conv_id", "pos", "initial", "fault"])


def stitched(parts: DataFrame) -> DataFrame:
    """For each segment of conversations that are not whole the chosen way: first, entry, exit, ending, and what is illegal between."""

    def task():
        state: dict = {}

        def close() -> Iterator[tuple]:
            if state:
                _, rest, ending = state["search"].end()
                chosen = [*state["search"].settled, *rest]
                state["search"].settled.clear()
                for i, (first, entry, leave) in enumerate(chosen):
                    last = i == len(chosen) - 1
                    yield first, entry, leave, ending if last else "", state["between"] if last else 0

        def work(rows: Rows) -> Rows:
            out: list[tuple] = []
            if not rows:
                out += close()
            for conv_id, first, head, tail, ways in zip(
                *[rows[n] for n in ("conv_id", "first", "head", "tail", "ways")] if rows else [()] * 5, strict=True
            ):
                if not state or state["conv_id"] != conv_id:
                    out += close()
                    state.update(conv_id=conv_id, search=Survivors(), between=0, tail=None)
                if state["tail"] is not None and state["tail"] + head not in ("su", "ua", "au"):
                    state["between"] += 1
                state["tail"] = tail
                state["search"].step(
                    (w["entry"], w["exit"], w["cost"], w["place"], (first, w["entry"], w["exit"])) for w in ways
                )
                # what is settled need not wait for the end of the conversation
                settled = state["search"].settled
                out += [(*s, "", 0) for s in settled[:-1]]
                del settled[:-1]
            names = ("first", "entry", "exit", "ending", "between")
            return {n: [o[i] for o in out] for i, n in enumerate(names)}

        return work

    bare = F.transform("ways", lambda w: F.struct(w["entry"].alias("entry"), w["exit"].alias("exit"), w["cost"].alias("cost"), w["place"].alias("place")))
    rows = parts.where("not whole").select("conv_id", "first", "head", "tail", bare.alias("ways"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "first")
    return map_batches(
        rows, "first long, entry int, exit int, ending string, between long", task, finish=True, read=rows.columns
    )


def audits(prepared: DataFrame) -> DataFrame:
    """conv_id, seg, first, entry, cost, audit, illegal of each conversation and segment, as a written table."""
    parts = cut_lineage(segments(prepared))
    way = F.col("ways")[0]
    whole = parts.where("whole").select(
        "conv_id", "seg", "first", F.lit(START).alias("entry"), way["cost"].alias("cost"), way["audit"].alias("audit"), "illegal"
    )
    chosen = parts.join(stitched(parts), "first")
    same = F.filter("ways", lambda w: (w["entry"] == F.col("entry")) & (w["exit"] == F.col("exit")))[0]
    extra = INSERT * F.length("ending")
    joined = chosen.select(
        "conv_id",
        "seg",
        "first",
        "entry",
        (same["cost"] + extra).alias("cost"),
        F.concat(same["audit"], "ending").alias("audit"),
        (F.col("illegal") + F.col("between")).alias("illegal"),
    )
    return cut_lineage(whole.union(joined))


def apply(prepared: DataFrame, chosen: DataFrame) -> DataFrame:
    """The edits as rows: conv_id, pos, sub, edit (K, R, D, I), turn, role, text; in order of pos, then sub.

    Deleted rows are there with their own role and text; inserted rows have no turn and empty text.
    """

    def task():
        state = {"edits": "", "at": 0, "place": START, "body": 0}

        def inserted(out: Rows, row: int, sub: int) -> int:
            while state["edits"][state["at"] : state["at"] + 1] == "I":
                state["at"] += 1
                to, letter = (ASSISTANT, "a") if state["place"] == USER else (USER, "u")
                state["place"] = to
                for name, value in zip(out, (sub, "I", ROLES[letter], "", True, row), strict=True):
                    out[name].append(value)
                sub += 1
            return sub

        def work(rows: Rows) -> Rows:
            out: Rows = {"sub": [], "edit": [], "role": [], "text": [], "inserted": [], "_row": []}
            for row, (audit, entry, role, text) in enumerate(
                zip(rows["audit"], rows["entry"], rows["_role"], rows["_text"], strict=True)
            ):
                if audit is not None:
                    state.update(edits=audit, at=0, place=entry, body=len(audit.rstrip("I")))
                    continue
                sub = inserted(out, row, 0)
                edit = state["edits"][state["at"]]
                state["at"] += 1
                if edit == "R":
                    to, letter = (ASSISTANT, "a") if state["place"] == USER else (USER, "u")
                    state["place"], role = to, ROLES[letter]
                elif edit == "K":
                    state["place"] = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                for name, value in zip(out, (sub, edit, role, text, False, row), strict=True):
                    out[name].append(value)
                # the last row of a conversation is followed by what is left of its edits
                if state["at"] == state["body"]:
                    inserted(out, row, sub + 1)
            return out

        return work

    steps = chosen.select(
        "conv_id", F.col("first").alias("pos"), F.lit(None).cast(prepared.schema["turn"].dataType).alias("turn"),
        F.lit(0).alias("kind"), "audit", "entry", F.lit(None).cast("string").alias("_role"), F.lit(None).cast("string").alias("_text"),
    )
    rows = prepared.select(
        "conv_id", "pos", "turn", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"),
        F.lit(None).cast("int").alias("entry"), F.col("role").alias("_role"), F.col("text").alias("_text"),
    )
    both = steps.union(rows).repartition(_seg()).sortWithinPartitions("pos", "kind")
    found = map_batches(
        both,
        "sub int, edit string, role string, text string, inserted boolean",
        task,
        keep=["conv_id", "pos", "turn"],
        read=["audit", "entry", "_role", "_text"],
    )
    turn = F.when(~F.col("inserted"), F.col("turn")).alias("turn")
    return found.select("conv_id", "pos", "sub", "edit", turn, "role", "text")


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its ``role:text`` lines, read as a stream; nothing of a conversation is gathered."""

    def task():
        state: dict = {}

        def work(rows: Rows) -> Rows:
            out: Rows = {"conv_id": [], "repaired_sha256": []}

            def close() -> None:
                if state:
                    out["conv_id"].append(state["conv_id"])
                    out["repaired_sha256"].append(state["hash"].hexdigest())

            if not rows:
                close()
                return out
            for conv_id, line in zip(rows["conv_id"], rows["line"], strict=True):
                if state and state["conv_id"] == conv_id:
                    state["hash"].update(b"\n")
                else:
                    close()
                    state.update(conv_id=conv_id, hash=hashlib.sha256())
                state["hash"].update(line.encode("utf-8", "surrogatepass"))
            return out

        return work

    lines = repaired.where("edit <> 'D'").select("conv_id", "pos", "sub", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "sub")
    kind = repaired.schema["conv_id"].dataType.simpleString()
    return map_batches(lines, f"conv_id {kind}, repaired_sha256 string", task, finish=True, read=["conv_id", "line"])


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(conversations, edits): one row per conversation with its faults, cost and audit; the edits as rows (see ``apply``)."""
    prepared = prepare(rows, conv_id, turn, role, text)
    chosen = audits(prepared)
    counts = [F.sum((F.col("fault") == f).cast("long")).alias(f) for f in FAULTS if f]
    per_turn = prepared.groupBy("conv_id", "turn").agg(*counts)
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    faults = per_turn.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), *[F.sum(f).alias(f) for f in FAULTS if f]
    )
    pieces = F.array_sort(F.collect_list(F.struct("first", "audit")))
    edits = chosen.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.concat_ws("", F.transform(pieces, lambda p: p["audit"])).alias("audit"),
    )
    same = faults["conv_id"].eqNullSafe(edits["conv_id"])
    return faults.join(edits, same).drop(edits["conv_id"]), apply(prepared, chosen)
