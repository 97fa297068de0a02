"""Document fingerprints by winnowing, in DataFrame operations only.

The grams of a text are its runs of ``GRAM`` words. Each gram has a hash of 33
bits; of every ``WINDOW`` grams in a row the least hash is chosen, the rightmost
of equal ones, and kept with its position. Two texts that share at least
``GRAM + WINDOW - 1`` words in a row share a fingerprint. A hash and its
position stand in one long, hash first and position backwards, so the rightmost
least gram of a window is simply the least number.

Defined results: a null text is empty; a text of fewer than ``GRAM`` words has
one gram, the whole of it; a text without words has no fingerprint, and two
such texts are alike; equal texts have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 3
WINDOW = 6
#: Bits for the position; a string of the JVM has fewer words.
_PLACE = 30
_LAST = (1 << _PLACE) - 1
_HASH = (1 << 33) - 1
#: Separators of words, after lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _steps(last: Column) -> Column:
    """0 .. last, none if that is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def with_fingerprint(df: DataFrame, text: Column, into: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``df`` with an array ``into`` of chosen grams, as longs of hash and position.

    One level of columns per step, each named once and used often, so that no
    step is evaluated again for every use.
    """
    words, grams = f"{into}_words", f"{into}_grams"
    df = df.withColumn(words, F.array_remove(F.split(F.lower(text), SEPARATORS), ""))

    def packed(hashed: Column, place: Column) -> Column:
        high = F.shiftleft(hashed.bitwiseAND(F.lit(_HASH).cast("long")), _PLACE)
        return high.bitwiseOR(F.lit(_LAST).cast("long") - place)

    def one_gram(i: Column) -> Column:
        return packed(F.xxhash64(*[F.get(F.col(words), i + j) for j in range(gram)]), i)

    whole = F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(
        F.array(packed(F.xxhash64(F.concat_ws(" ", words)), F.lit(0)))
    )
    df = df.withColumn(
        grams,
        F.when(F.size(words) < gram, whole).otherwise(F.transform(_steps(F.size(words) - gram), one_gram)),
    ).drop(words)

    def least_of_all(i: Column) -> Column:
        return F.least(*[F.get(F.col(grams), i + j) for j in range(window)])

    chosen = F.when(
        F.size(grams) <= window,
        F.when(F.size(grams) > 0, F.array(F.array_min(grams))).otherwise(F.col(grams)),
    ).otherwise(F.array_distinct(F.transform(_steps(F.size(grams) - window), least_of_all)))
    return df.withColumn(into, chosen).drop(grams)


def hashes(chosen: Column) -> Column:
    """Hashes of the chosen grams in text order."""
    return F.transform(chosen, lambda v: F.shiftright(v, _PLACE))


def positions(chosen: Column) -> Column:
    """Word numbers at which the chosen grams begin."""
    return F.transform(chosen, lambda v: (F.lit(_LAST).cast("long") - v.bitwiseAND(F.lit(_LAST).cast("long"))))


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all; 1 for two empty sets."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / either)


def _bucket(doc_id: Column, bounds: list, low: int = 0) -> Column:
    """Number of the first bound that is not below ``doc_id``, by halving; 0 for null."""
    if len(bounds) == 1:
        return F.lit(low)
    half = len(bounds) // 2
    return F.when(doc_id > F.lit(bounds[half - 1]), _bucket(doc_id, bounds[half:], low + half)).otherwise(
        _bucket(doc_id, bounds[:half], low)
    )


def with_next(
    df: DataFrame,
    doc_id: str,
    order: list[Column],
    prepare: Callable[[DataFrame], DataFrame],
    columns: list[str],
    into: str,
) -> DataFrame:
    """``prepare(df)`` with a struct ``into`` of the next row's ``columns``, by descending ``doc_id``.

    The last row has the first as its next. Rows are dealt out by ranges of
    ids, so no task sorts them all; the row that opens a range is also laid
    behind the last row of the range before. What ``prepare`` adds to the rows
    of ``df`` is made after they are dealt out and need not be moved.
    """
    number = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    thin = df.select(F.col(doc_id).alias("id"))
    bounds = thin.repartitionByRange(number, "id").groupBy(F.spark_partition_id()).agg(F.max("id").alias("top"))
    tops = sorted({r["top"] for r in bounds.collect() if r["top"] is not None}) or [None]
    key = F.col(doc_id)
    bucket = _bucket(key, tops)
    heads = F.array(*[F.lit(t) for t in tops])
    spread = df.withColumn("_bucket", bucket)
    opens = key.eqNullSafe(F.get(heads, F.col("_bucket")))
    own = F.struct(F.col("_bucket").alias("bucket"), F.lit(0).alias("guest"))
    behind = F.struct(((F.col("_bucket") + 1) % len(tops)).alias("bucket"), F.lit(1).alias("guest"))
    spread = spread.withColumn("_place", F.explode(F.when(opens, F.array(own, behind)).otherwise(F.array(own))))
    spread = spread.select(*df.columns, F.col("_place.bucket").alias("_bucket"), F.col("_place.guest").alias("_guest"))
    following = Window.partitionBy("_bucket").orderBy("_guest", *order)
    return (
        prepare(spread.repartition("_bucket"))
        .withColumn(into, F.lead(F.struct(*columns)).over(following))
        .where("_guest = 0")
        .drop("_bucket", "_guest")
    )


def fingerprints(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """doc_id, hashes and positions of every document's fingerprint."""
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    chosen = with_fingerprint(thin, F.col("_text"), "_chosen", gram, window)
    return chosen.select("doc_id", hashes(F.col("_chosen")).alias("hashes"), positions(F.col("_chosen")).alias("positions"))


def compare_with_next(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """Every document with its edited text, both fingerprints, and their likeness to it and to the next document.

    The edited text has the last half of the code points replaced by as many
    from the beginning of the next document, by descending ``doc_id``.
    """
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("_text").desc()]
    paired = with_next(
        thin,
        "doc_id",
        order,
        lambda df: with_fingerprint(df, F.col("_text"), "_own", gram, window),
        ["_text", "_own"],
        "_next",
    )
    half = F.floor(F.length("_text") / 2).cast("int")
    paired = paired.withColumn(
        "edited",
        F.concat(F.substring("_text", F.lit(1), F.length("_text") - half), F.substring("_next._text", F.lit(1), half)),
    )
    paired = with_fingerprint(paired, F.col("edited"), "_other", gram, window)
    return paired.select(
        "doc_id",
        F.length("_text").cast("long").alias("n_chars"),
        "edited",
        hashes(F.col("_own")).alias("hashes"),
        positions(F.col("_own")).alias("positions"),
        hashes(F.col("_other")).alias("edited_hashes"),
        positions(F.col("_other")).alias("edited_positions"),
        hashes(F.col("_next._own")).alias("next_hashes"),
    ).withColumns(
        {
            "near_edited": likeness(F.col("hashes"), F.col("edited_hashes")),
            "near_next": likeness(F.col("hashes"), F.col("next_hashes")),
        }
    )
