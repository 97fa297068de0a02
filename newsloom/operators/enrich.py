"""Replace listing snippets by the text of the article they link to."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUN = ("source", "date")


def first_linked(
    articles: DataFrame,
    limit: int | None = None,
    per: tuple[str, ...] = RUN,
    order_col: str = "ord",
    flag: str = "needs_full_scrape",
) -> DataFrame:
    """Thin rows of the flagged articles, the first ``limit`` of each run if there is one.

    The rank is cut to ``limit`` before its shuffle, so a run with very many
    articles costs no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*per).orderBy(order_col))
    flagged = articles.where(F.col(flag)).select(*per, order_col, "url")
    if limit is None:
        return flagged
    return flagged.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def enrich_linked(
    articles: DataFrame,
    bodies: DataFrame,
    limit: int | None = None,
    per: tuple[str, ...] = RUN,
    order_col: str = "ord",
    flag: str = "needs_full_scrape",
) -> DataFrame:
    """Flagged articles (the first ``limit`` of each run) take content and source from ``bodies``.

    ``bodies(url, content, raw_html)`` has one row per fetched URL; articles
    whose URL has no body stay as they are.
    """
    body = bodies.select("url", F.col("content").alias("_c"), F.col("raw_html").alias("_r"))
    found = first_linked(articles, limit, per, order_col, flag).join(body, "url").drop("url")
    return (
        articles.join(found, [*per, order_col], "left")
        .withColumn("content", F.coalesce("_c", "content"))
        .withColumn("raw_html", F.coalesce("_r", "raw_html"))
        .select(*articles.columns)
    )
