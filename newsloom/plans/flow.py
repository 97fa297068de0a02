"""The whole run and its stages, as compositions of the operators.

Stages meet in tables below one base path, so each can run alone:

``raw`` (source, date) -> ``prompts`` (date) -> external model -> ``responses``
-> ``processed`` (date) -> ``published`` and ``manifest``. Rows a stage cannot
use go to ``rejects``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.dedup import deduplicate
from ..operators.enrich import enrich_linked, first_linked
from ..operators.extract import extract_body, extract_records, without_rule
from ..operators.frontier import select_sites
from ..operators.prompts import assemble_articles, build_prompt, unanswered, with_template
from ..operators.publish import manifest_rows, unpublished
from ..operators.rejects import split_rejects, with_error
from ..operators.render import (
    article_fields,
    frontmatter,
    render_markdown,
    rss_item,
    split_frontmatter,
    wrap_html,
    written_over,
)
from ..operators.scoring import seo_report, seo_score
from ..operators.skew import small, spread
from ..session import cut_lineage
from ..sources import catalog
from ..sources.pages import pages_of_sites, read_pages
from ..sources.processed import read_processed, write_processed
from ..sources.published import append_manifest, known_slugs, open_batch, read_manifest, write_published
from ..sources.raw import read_day, write_raw
from .settings import Settings

STAGES = ("extract", "prompt", "rewrite", "publish")


def _day_table(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _keep_rejects(df: DataFrame, base: str, stage: str, date: str, batch_id: str) -> None:
    rows = df.select(F.col("error"), F.to_json(F.struct("*")).alias("row"))
    rows = rows.withColumns({"stage": F.lit(stage), "date": F.lit(date), "batch_id": F.lit(batch_id)})
    _day_table(rows, f"{base}/rejects", "stage", "date", "batch_id")


def articles_of_pages(pages: DataFrame, sites: DataFrame, date: str, settings: Settings) -> DataFrame:
    """Extracted and enriched article rows of a table of fetched pages."""
    spark = pages.sparkSession
    listing = pages_of_sites(pages, sites).drop("base_url")
    is_linked = F.col("source") == settings.linked_source

    def records(some_pages: DataFrame) -> DataFrame:
        rows = extract_records(some_pages, catalog.rules(spark), sites, catalog.category_rules(spark))
        return rows.select(
            "*",
            F.lit(date).alias("date"),
            F.struct("source", "page_id", "pos").alias("ord"),
            F.concat_ws("-", "source", F.lit(date), "page_id", "pos").alias("article_id"),
        )

    # read several times below, so its pages are parsed once and kept
    linked = cut_lineage(records(listing.where(is_linked)))
    # only the pages that are linked to are parsed for a body
    wanted = small(first_linked(linked, settings.linked_limit).select("url").distinct())
    bodies = extract_body(pages.join(wanted, "url", "left_semi"))
    rows = records(listing.where(~is_linked)).unionByName(enrich_linked(linked, bodies, settings.linked_limit))
    return rows.drop("needs_full_scrape", "page_id", "pos")


def prompts_of(
    articles: DataFrame, templates: DataFrame, date: str, settings: Settings
) -> tuple[DataFrame, DataFrame]:
    """``(articles with prompts, rejects)``; removes repeats first when asked to."""
    rows = articles.drop("raw_html", "scraped_at")
    if settings.deduplicate:
        rows = deduplicate(rows, "ord", settings.threshold)
    good, bad = with_template(rows, templates)
    return build_prompt(good, date, list(settings.default_keywords)).drop("template"), bad


def scored_articles(prompts: DataFrame, responses: DataFrame, date: str, settings: Settings) -> DataFrame:
    """Answered articles with score, Markdown and file name; ``error`` marks unusable ones."""
    rows = assemble_articles(prompts, responses, date)
    rows = frontmatter(seo_score(rows, placeholder=settings.placeholder))
    return with_error(rows, (strip("title") == "", "response without a title"))


def read_articles(processed: DataFrame, date: str, settings: Settings) -> DataFrame:
    """Front matter, slug and body of processed texts; ``error`` marks unreadable ones."""
    return article_fields(split_frontmatter(spread(processed.drop("date")), mode=settings.frontmatter_mode), date)


def formatted(rows: DataFrame, settings: Settings) -> DataFrame:
    """HTML and feed item of articles that were read."""
    rows = wrap_html(
        render_markdown(rows, escape_html=settings.escape_html),
        settings.author,
        settings.default_category,
        settings.escape_html,
    )
    return rss_item(rows, settings.author, settings.link_base)


def publish_batch(
    articles: DataFrame, base: str, batch_id: str, settings: Settings = Settings(), order_col: str = "stem"
) -> DataFrame:
    """Publish what the manifest does not know yet and record it, manifest last.

    What is left to publish is settled on slugs; only that is rendered. What
    the manifest has is never published again nor written over, whatever the
    batch is called.
    """
    spark = articles.sparkSession
    batch_id = open_batch(read_manifest(spark, f"{base}/manifest"), batch_id)
    asked = cut_lineage(articles.select("slug", order_col))
    todo = cut_lineage(unpublished(asked, known_slugs(asked, f"{base}/manifest"), order_col))
    written = write_published(
        formatted(articles.join(todo, ["slug", order_col], "left_semi"), settings), f"{base}/published", batch_id
    )
    append_manifest(manifest_rows(written, f"{base}/published"), f"{base}/manifest", batch_id)
    return written


def run_stages(
    spark: SparkSession,
    base: str,
    date: str,
    stages: tuple[str, ...] = STAGES,
    pages_path: str | None = None,
    wanted_sites: tuple[str, ...] | None = None,
    settings: Settings = Settings(),
    batch_id: str | None = None,
) -> dict[str, DataFrame]:
    """Run the chosen stages for one day and return what each wrote.

    Keys: ``raw`` counts, ``unknown_sites``, ``missing_sites``, ``prompts``,
    ``seo`` report, ``published``.
    """
    batch_id = batch_id or f"day-{date}"
    sites = catalog.sites(spark)
    out: dict[str, DataFrame] = {}
    if wanted_sites is not None:
        wanted = spark.createDataFrame([(s,) for s in wanted_sites], "source string")
        sites, out["unknown_sites"] = select_sites(sites, wanted)
    if "extract" in stages:
        pages = read_pages(spark, pages_path or f"{base}/pages")
        rows = articles_of_pages(pages, sites, date, settings)
        listing = pages_of_sites(pages, sites)
        _keep_rejects(without_rule(listing, catalog.rules(spark)), base, "extract", date, batch_id)
        write_raw(rows, f"{base}/raw", scraped_at=f"{date}T00:00:00+00:00")
        stored = spark.read.parquet(f"{base}/raw").where(F.col("date") == date)
        out["raw"] = stored.groupBy("source", "date").agg(F.count(F.lit(1)).alias("records"))
    if "prompt" in stages:
        day, out["missing_sites"] = read_day(spark.read.parquet(f"{base}/raw"), sites, date)
        day = day.join(sites.select("source"), "source", "left_semi")
        good, bad = prompts_of(day, catalog.templates(spark, settings.placeholder), date, settings)
        _day_table(good, f"{base}/prompts", "date")
        _keep_rejects(bad, base, "prompt", date, batch_id)
        out["prompts"] = spark.read.parquet(f"{base}/prompts").where(F.col("date") == date)
    if "rewrite" in stages:
        prompts = spark.read.parquet(f"{base}/prompts").where(F.col("date") == date).drop("date")
        responses = spark.read.parquet(f"{base}/responses")
        scored = scored_articles(spread(prompts), spread(responses), date, settings)
        _day_table(scored, f"{base}/scored", "date")
        scored = spark.read.parquet(f"{base}/scored").where(F.col("date") == date)
        good, bad = split_rejects(scored)
        write_processed(good, f"{base}/processed")
        _keep_rejects(bad, base, "rewrite", date, batch_id)
        _keep_rejects(unanswered(prompts, responses), base, "unanswered", date, batch_id)
        _keep_rejects(written_over(good, "date", "output_file"), base, "written over", date, batch_id)
        out["seo"] = seo_report(good)
    if "publish" in stages:
        # read three times below, so the texts are dealt out and parsed once
        articles = cut_lineage(read_articles(read_processed(spark, f"{base}/processed", date), date, settings).drop("text"))
        good, bad = split_rejects(articles)
        out["published"] = publish_batch(good, base, batch_id, settings)
        _keep_rejects(bad.select("stem", "error"), base, "publish", date, batch_id)
    return out
