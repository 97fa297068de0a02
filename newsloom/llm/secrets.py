"""Secret scans with a trigram inverted index, in DataFrame operations only.

The regex of every rule gives a Boolean trigram query. The index holds, for
each trigram that occurs in some query, the documents with that trigram; the
postings of an alternative are intersected by collecting its trigrams per
document. Only candidates run through the regex of a rule. A rule without
mandatory trigrams runs over all documents.

Defined results: a null or empty text has no spans; every row is scanned by
itself; repeated rows give equal results; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .trigrams import Query, query_of


@dataclass(frozen=True)
class Rule:
    """``group`` of each match must have ``least`` characters, or the match is dropped."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0


# The base kinds, in order. Runs of a class are matched whole, so the
# length can stand in the pattern where a shorter match could not begin another one.
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)

# Public shapes of keys and tokens.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE

#: Candidates that are sent to every task; more are joined by key.
BROADCAST_ROWS = 100_000


def postings(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: one row per trigram and document that has it."""
    low = F.lower("_text")
    present = F.array_compact(F.array(*[F.when(low.contains(t), F.lit(t)) for t in trigrams]))
    return keyed.select("_id", "_hash", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """Documents (``_id``, ``_hash``) with the rules whose query their postings satisfy."""
    alternatives = [(kind, sorted(a)) for kind, q in queries.items() if q for a in q]
    uses: dict[str, list[Column]] = {}
    for number, (_, trigrams) in enumerate(alternatives):
        for bit, trigram in enumerate(trigrams):
            uses.setdefault(trigram, []).append(
                F.struct(F.lit(number).alias("alternative"), F.lit(1 << bit).cast("long").alias("bit"))
            )
    none = F.array().cast("array<struct<alternative: int, bit: bigint>>")
    use = none
    for trigram, places in uses.items():
        use = F.when(F.col("trigram") == trigram, F.array(*places)).otherwise(use)
    full = F.array(*[F.lit((1 << len(t)) - 1).cast("long") for _, t in alternatives])
    kinds = F.array(*[F.lit(kind) for kind, _ in alternatives])
    met = (
        index.select("_id", "_hash", F.explode(use).alias("u"))
        .groupBy("_id", "_hash", F.col("u.alternative").alias("alternative"))
        .agg(F.bit_or("u.bit").alias("bits"))
        .where(F.col("bits") == F.get(full, F.col("alternative")))
    )
    return met.groupBy("_id", "_hash").agg(F.collect_set(F.get(kinds, F.col("alternative"))).alias("_rules"))


def spans(text: Column, rule: Rule) -> Column:
    """Places of a rule's matches in a text, as code points; array of (start, end)."""
    matches = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else matches
    between = F.split(text, rule.regex, -1)
    kind = "array<struct<start: int, end: int>>"
    steps = F.arrays_zip(
        F.transform(F.slice(between, 1, F.size(matches)), F.length).alias("gap"),
        F.transform(matches, F.length).alias("size"),
        F.transform(checked, F.length).alias("checked"),
    )

    def step(state: Column, s: Column) -> Column:
        start = state["at"] + s["gap"]
        end = start + s["size"]
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        out = F.when(s["checked"] >= rule.least, F.concat(state["out"], one)).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    return F.aggregate(steps, start, step, lambda state: state["out"])


def _labelled(places: Column, order: int, kind: str) -> Column:
    def one(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")
        )

    return F.transform(places, one)


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id and spans (kind, start, end) by start, then kind in the order of ``rules``."""
    queries = {r.kind: query_of(r.regex) for r in rules}
    trigrams = sorted({t for q in queries.values() if q for a in q for t in a})
    keyed = docs.select(
        F.col(doc_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")
    ).withColumn("_hash", F.xxhash64("_text"))
    index = cut_lineage(postings(keyed, trigrams))
    chosen = cut_lineage(candidates(index, queries)).withColumnsRenamed({"_id": "_id2", "_hash": "_hash2"})
    few = chosen.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = keyed.join(
        F.broadcast(chosen) if few else chosen,
        F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_hash") == F.col("_hash2")),
        "left",
    )
    found = []
    for order, rule in enumerate(rules):
        asked = F.col("_text").rlike(rule.regex)
        if queries[rule.kind] is not None:
            asked = F.coalesce(F.array_contains("_rules", rule.kind), F.lit(False)) & asked
        found.append(F.when(asked, _labelled(spans(F.col("_text"), rule), order, rule.kind)))
    every = F.array_sort(F.flatten(F.array_compact(F.array(*found))))
    return joined.select(
        F.col("_id").alias("doc_id"),
        F.transform(every, lambda s: F.struct(s["kind"], s["start"], s["end"])).alias("spans"),
    )
