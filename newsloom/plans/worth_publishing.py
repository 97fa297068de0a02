"""Flagship question: which pages are worth publishing?"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.html import body_fragment, page_title, visible_text
from ..functions.text import slugify
from ..operators.scoring import seo_score


def worth_publishing(pages: DataFrame) -> DataFrame:
    """Score every page's article and keep the first page of each slug, best first."""
    fields = pages.select(
        "page_id",
        page_title("html").alias("title"),
        visible_text(body_fragment("html")).alias("body"),
    )
    fields = fields.withColumn("meta_description", F.left(F.translate("body", "\n", " "), F.lit(160)))
    scored = seo_score(fields.withColumn("keywords", F.array(F.lit("the"), F.lit("and"))))
    thin = scored.select(
        "page_id", "title", slugify("title").alias("slug"), F.col("seo.score").alias("score"),
        F.col("seo.passed").alias("passed"), F.array_join("seo.issues", "|").alias("issues"),
    )
    rank = F.row_number().over(Window.partitionBy("slug").orderBy("page_id"))
    first = thin.where("slug <> ''").withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return first.orderBy(F.desc("score"), "page_id")
