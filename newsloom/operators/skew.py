"""Joins on keys of which a few may hold a large share of the rows, and rows of which a few tasks would hold all."""

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than 1/HOT_SHARE of the rows, so there are
#: fewer than HOT_SHARE hot keys whatever the data looks like.
HOT_SHARE = 1000
#: Below this many rows per key one task copes, and nothing is treated as hot.
HOT_MIN_ROWS = 1_000_000
#: Rows of one hot key handled by one task.
ROWS_PER_SALT = 500_000


def hot_keys(df: DataFrame, key: str, total: int, min_rows: int = HOT_MIN_ROWS) -> DataFrame:
    """Hot values of ``key`` with the number of salts each needs; < HOT_SHARE rows."""
    per_salt = max(1, min(ROWS_PER_SALT, min_rows // 2))
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > max(min_rows, total // HOT_SHARE)).select(
        key, F.ceil(F.col("_n") / F.lit(per_salt)).cast("int").alias("_salts")
    )


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: str,
    total: int,
    how: str = "left",
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Join many ``rows`` to a ``table`` that has at most one row per ``key``.

    Hot keys are spread over salts on the row side and copied per salt on the
    table side; the list of hot keys is bounded (see ``HOT_SHARE``), hence the
    broadcast. With fewer rows than ``min_rows`` no key can be hot and this is
    a plain equi-join.
    """
    if total <= min_rows:
        return rows.join(table, key, how)
    hot = F.broadcast(hot_keys(rows, key, total, min_rows))
    salted_rows = rows.join(hot, key, "left").withColumn(
        "_salt",
        F.when(F.col("_salts").isNull(), 0).otherwise(
            F.pmod(F.xxhash64(spread_by), F.col("_salts").cast("bigint")).cast("int")
        ),
    )
    salted_table = table.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0))))
    )
    return salted_rows.drop("_salts").join(salted_table.drop("_salts"), [key, "_salt"], how).drop("_salt")


#: Most rows a configuration table may have to be sent to every task.
SMALL_ROWS = 10_000


def small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast a configuration table (sites, rules, templates) if it really is small.

    Reads at most ``max_rows + 1`` rows to find out. A larger table is joined by
    key like any other. Tables built from local rows carry no size of their
    own, and left to itself the planner may send the big side instead.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


#: Rows that one task copes with at once whatever is done to them.
TASK_ROWS = 200


def spread(table: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Rows of a written ``table`` dealt out evenly, for steps whose cost is in the work per row, not in the bytes.

    A file with hundreds of megabytes of text may have a single row group, which one task reads, and adaptive execution
    would merge small partitions, so the count is explicit.
    """
    spark = table.sparkSession
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    tasks = min(most, ceil(table.count() / task_rows))
    return table.repartition(tasks) if tasks > 1 else table
