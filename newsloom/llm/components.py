"""Connected components by alternating stars, on Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_and_measure

#: Rounds after which something must be wrong; a few suffice for any graph met so far.
MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") > F.col("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` links in, ``(u, v)`` out: each vertex but the least of its component, with that least one.

    Every round is written to the shared folder. Hot vertices are aggregated
    before the shuffle; the joins on them are equi-joins that Spark may split.
    """
    # links are often dear to find and are read more than once
    links, found = cut_and_measure(
        edges.toDF("u", "v").where(F.col("u") != F.col("v")).distinct(), n=F.count(F.lit(1))
    )
    if not found["n"]:
        return links
    measures = {"n": F.count(F.lit(1)), "s": F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit(0xFFFFFFFF)))}
    stars, before = cut_and_measure(_small_star(links), **measures)
    for _ in range(MAX_ROUNDS):
        stars, now = cut_and_measure(_small_star(_large_star(stars)), **measures)
        if now == before:
            return stars
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
