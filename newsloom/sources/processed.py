"""Processed Markdown: one table per day, with a file-per-article export."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.render import last_per_path
from .raw import path_exists


def write_processed(df: DataFrame, path: str, layout: str = "table", order_col: str = "ord") -> None:
    """Write articles with ``markdown``, ``output_file`` and ``date``.

    Equal file names of a day: the last one wins, also over earlier calls;
    other names stay. ``table`` is Parquet by date and run, a new run for every
    call; ``files`` puts each text in a folder of its own below the date.
    """
    final = last_per_path(df, "date", "output_file", order_col=order_col)
    if layout == "files":
        out = final.select("date", F.col("output_file").alias("file"), F.col("markdown").alias("value"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("lineSep", "\n").partitionBy(
            "date", "file"
        ).text(path)
        return
    stem = F.regexp_replace("output_file", r"\.md\z", "")
    out = final.select(
        "date", stem.alias("stem"), F.col("markdown").alias("text"), F.lit(_next_run(df.sparkSession, path)).alias("run")
    )
    out.hint("rebalance", "date").write.mode("append").partitionBy("date", "run").parquet(path)


_STORED = T.StructType([*schemas.PROCESSED.fields, T.StructField("run", T.LongType())])


def _next_run(spark: SparkSession, path: str) -> int:
    """One more than the runs written so far; only partition names are read."""
    if not path_exists(spark, path):
        return 1
    return (spark.read.schema(_STORED).parquet(path).agg(F.max("run")).first()[0] or 0) + 1


def read_processed(spark: SparkSession, path: str, date: str, layout: str = "table") -> DataFrame:
    """``(date, stem, text)`` of one day; a missing day gives no rows.

    ``files`` reads Markdown files below ``<path>/<date>`` or
    ``<path>/date=<date>``, one text per file.
    """
    if layout == "table":
        if not path_exists(spark, f"{path}/date={date}"):
            return spark.createDataFrame([], schemas.PROCESSED)
        rows = spark.read.schema(_STORED).parquet(path).where(F.col("date") == date)
        if rows.select("run").distinct().count() > 1:
            rows = last_per_path(rows, "stem", order_col="run")
        return rows.select("date", "stem", "text")
    day = next((d for d in (f"{path}/{date}", f"{path}/date={date}") if path_exists(spark, d)), None)
    if day is None:
        return spark.createDataFrame([], schemas.PROCESSED)
    rows = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{md,txt}")
        .text(day, wholetext=True)
    )
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/file=([^/]+)/", 1)
    name = F.coalesce(F.nullif(folder, F.lit("")), F.col("_metadata.file_name"))
    # the writer ends each text with a line feed of its own
    text = F.when(folder != "", F.regexp_replace("value", r"\n\z", "")).otherwise(F.col("value"))
    return rows.select(F.lit(date).alias("date"), F.regexp_replace(name, r"\.md\z", "").alias("stem"), text.alias("text"))
