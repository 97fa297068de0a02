"""The registered queries of this package; each applies one operator to whole tables."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    best_fit,
    conversation_repair,
    decontaminate,
    gray_index,
    licences,
    line_dedup,
    merge_replay,
    packing,
    secrets,
    token_counts,
    toxicity,
    whitening,
    winnow,
)
from .inputs import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.annotate(docs, items, keep=["doc_id"])
    n_hit = F.aggregate("leak.spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id",
        F.col("leak.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "leak.items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    def written(hashes: str) -> Column:
        return F.concat_ws(" ", F.transform(hashes, lambda h: F.lower(F.hex(h))))

    return winnow.compare_with_next(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        written("hashes").alias("fingerprint"),
        written("edited_hashes").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op4_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = best_fit.pack_matrices(table(spark, sf_dir, "documents"))
    return packed.select(
        "sequence_id",
        "n_ids",
        F.crc32("ids").alias("ids_crc32"),
        "cu_seqlens",
        F.crc32("position_ids").alias("position_ids_crc32"),
        "segments",
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document that is left: its text's digest and the lines that went."""
    left = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), distance=None)
    return left.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
        F.coalesce(F.size("removed_lines"), F.lit(0)).cast("long").alias("n_removed"),
        "removed_lines",
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    starts = F.col("places.word")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct("places.label"))).alias("base_labels"),
        F.concat_ws(",", "labels").alias("labels"),
        "score",
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def written(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(written(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gray_index.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = merge_replay.encode(table(spark, sf_dir, "documents"))
    decoded = merge_replay.decode(encoded, keep=["doc_id", "ids"])
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated or under another role, as told by a checksum."""
    kept = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.col("_kind")
    rows = rows.withColumn("_kind", F.pmod(F.crc32(F.concat_ws(":", *kept)), F.lit(20)))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return (
        rows.where(kind != 0)
        .select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
        .drop("_copy")
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_rows(rows)


def conversation_rows(rows: DataFrame) -> DataFrame:
    """What ``op12_conversation_repair`` returns of a table; conversations that lost all rows have zeros."""
    found, edits = conversation_repair.repair(damaged(rows))
    out = rows.select(F.col("conv_id").alias("_conv")).distinct()
    for part in (found, conversation_repair.digests(edits)):
        out = out.join(part, F.col("_conv").eqNullSafe(part["conv_id"]), "left").drop(part["conv_id"])
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        F.col("_conv").alias("conv_id"),
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_decontamination": op2_decontamination,
        "op3_winnowing": op3_winnowing,
        "op4_token_matrices": op4_token_matrices,
        "op5_token_counts": op5_token_counts,
        "op6_line_dedup": op6_line_dedup,
        "op7_toxicity": op7_toxicity,
        "op8_licences": op8_licences,
        "op9_secrets": op9_secrets,
        "op10_simhash": op10_simhash,
        "op11_byte_bpe": op11_byte_bpe,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_whitening": op13_whitening,
    }


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(
    string.ascii_uppercase, string.ascii_lowercase
)


def oracle_sql() -> dict[str, str]:
    """What SQL can express of these queries."""
    return {
        "op2_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), {decontaminate.WINDOW}) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS t
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM i WHERE k > 0)),
places AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS t
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
met AS MATERIALIZED (SELECT doc_id, item_id, k, p FROM places JOIN windows USING (k, t)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS pos FROM met) GROUP BY doc_id),
of AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM met) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN of USING (doc_id)""",
    }
