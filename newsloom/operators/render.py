"""Front matter, article fields, HTML and feed items."""

import json

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import markdown as M
from ..functions.response import flat_meta, frontmatter_block, frontmatter_body, read_meta
from ..functions.templating import fill
from ..functions.text import json_string_list, safe_filename, strip, title_case, xml_escape

try:
    import yaml
except ImportError:  # YAML mode is optional, the flat mode needs nothing
    yaml = None

DEFAULT_AUTHOR = "Editorial AI"
DEFAULT_CATEGORY = "Sports Betting"
DEFAULT_LINK_BASE = "https://example.com/blog/"

# The three output formats.
FRONTMATTER = """\
---
title: "{title}"
meta_description: "{meta_description}"
category: "{content_type}"
sport: "{sport}"
source: "{source}"
date: "{date}"
keywords: {keywords}
seo_score: {score}
---
"""

ARTICLE_HTML = """\
<article class="blog-post">
  <header>
    <h1>{title}</h1>
    <div class="meta">
      <span class="author">{author}</span>
      <time datetime="{date}">{date}</time>
      <span class="category">{category}</span>
    </div>
    {tags}
    <!-- featured image placeholder -->
    <div class="featured-image" data-src=""></div>
  </header>
  <div class="content">
{content}
  </div>
</article>
"""

RSS_ITEM = """\
<item>
  <title>{title}</title>
  <link>{link_base}{slug}</link>
  <description>{description}</description>
  <pubDate>{date}</pubDate>
  <author>{author}</author>
</item>
"""


def frontmatter(df: DataFrame) -> DataFrame:
    """Add ``markdown`` (front matter and body) and ``output_file`` to scored articles."""
    head = fill(
        FRONTMATTER,
        title=F.col("title"),
        meta_description=F.col("meta_description"),
        content_type=F.col("content_type"),
        sport=F.col("sport"),
        source=F.col("source"),
        date=F.col("date"),
        keywords=json_string_list(F.coalesce("keywords", F.array().cast("array<string>"))),
        score=F.col("seo.score").cast("string"),
    )
    return df.withColumn("markdown", F.concat(head, F.lit("\n"), F.col("body"))).withColumn(
        "output_file", safe_filename("content_type", "title")
    )


def last_per_path(df: DataFrame, *path: str, order_col: str = "ord") -> DataFrame:
    """The last row by ``order_col`` of every output path.

    The rank is limited before its shuffle, so a path written very often costs
    no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*path).orderBy(F.desc(order_col)))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def written_over(df: DataFrame, *path: str, order_col: str = "ord") -> DataFrame:
    """Thin rows that ``last_per_path`` leaves out, with ``error``."""
    thin = df.select(*path, order_col)
    last = thin.groupBy(*path).agg(F.max(order_col).alias("_last"))
    out = thin.join(last, list(path)).where(F.col(order_col) < F.col("_last")).drop("_last")
    return out.withColumn("error", F.lit("written over by a later article"))


def _yaml_batches(blocks: pd.Series) -> pd.DataFrame:
    rows = []
    for text in blocks:
        try:
            meta = yaml.safe_load(text) or {}
            if not isinstance(meta, dict):
                raise ValueError("front matter is not a mapping")
            rows.append((json.dumps(meta, default=str, ensure_ascii=False), None))
        except (yaml.YAMLError, ValueError) as e:
            rows.append((None, f"front matter: {type(e).__name__}"))
    return pd.DataFrame(rows, columns=["meta", "error"])


def split_frontmatter(df: DataFrame, text: str = "text", mode: str = "flat") -> DataFrame:
    """Add ``meta MAP``, ``tags ARRAY``, ``body`` and ``error`` to processed texts.

    ``flat`` reads ``key: value`` lines inside the engine. ``lines`` also reads
    quoted scalars and lists there (see ``read_meta``). ``yaml`` reads full
    YAML in Arrow batches. In both a block that does not parse sets ``error``.
    """
    block = frontmatter_block(text)
    if mode == "lines":
        empty = F.create_map().cast("map<string,string>")
        out = df.withColumn("_y", read_meta(block))
        error = F.col("_y.error")
        out = out.withColumn("meta", F.when(error.isNull(), F.col("_y.meta")).otherwise(empty))
        tags = F.when(error.isNull(), F.try_element_at("_y.lists", F.lit("tags")))
    elif mode == "flat":
        meta = flat_meta(block)
        tags = F.from_json(F.try_element_at(meta, F.lit("tags")), "array<string>")
        error = F.lit(None).cast("string")
        out = df.withColumn("meta", meta)
    else:
        if yaml is None:
            raise RuntimeError("YAML mode needs the yaml module")
        read = F.pandas_udf(_yaml_batches, "meta string, error string")
        out = df.withColumn("_y", read(block))
        error = F.col("_y.error")
        meta = F.coalesce(F.from_json("_y.meta", "map<string,string>"), F.create_map().cast("map<string,string>"))
        tags = F.from_json(F.get_json_object("_y.meta", "$.tags"), "array<string>")
        out = out.withColumn("meta", meta)
    return (
        out.withColumn("tags", F.coalesce(tags, F.array().cast("array<string>")))
        .withColumn("body", frontmatter_body(text))
        .withColumn("error", error)
        .drop("_y")
    )


def article_fields(df: DataFrame, date: str) -> DataFrame:
    """Add ``title``, ``slug`` and ``date`` from ``meta`` or, failing that, from the file stem."""
    meta = lambda key: F.try_element_at("meta", F.lit(key))
    from_stem = title_case(F.replace(F.col("stem"), F.lit("-"), F.lit(" ")))
    return (
        df.withColumn("title", F.coalesce(meta("title"), from_stem))
        .withColumn("slug", F.coalesce(meta("slug"), F.col("stem")))
        .withColumn("date", F.coalesce(meta("date"), F.lit(date)))
    )


def markdown_blocks(df: DataFrame, *keys: str, body: str = "body") -> DataFrame:
    """One row per Markdown block: ``pos``, ``kind``, ``level`` and its text."""
    rows = df.select(*keys, F.posexplode(M.blocks(body)).alias("pos", "block"))
    kind = M.block_kind("block")
    return rows.select(
        *keys,
        "pos",
        kind.alias("kind"),
        F.when(kind == "heading", M.heading_level("block")).otherwise(0).alias("level"),
        F.when(kind == "heading", M.heading_text("block")).otherwise(F.col("block")).alias("block"),
    )


def render_markdown(df: DataFrame, body: str = "body", escape_html: bool = True) -> DataFrame:
    """Add ``content_html``."""
    return df.withColumn("content_html", M.markdown_html(body, escape_html))


def wrap_html(
    df: DataFrame,
    author: str = DEFAULT_AUTHOR,
    default_category: str = DEFAULT_CATEGORY,
    escape_html: bool = True,
) -> DataFrame:
    """Add ``html``, the article page around ``content_html``.

    ``escape_html=False`` puts title, category and tags in unchanged.
    """
    shown = xml_escape if escape_html else (lambda c: c)
    spans = F.array_join(
        F.transform("tags", lambda t: F.concat(F.lit('<span class="tag">'), shown(t), F.lit("</span>"))), ""
    )
    category = F.coalesce(F.try_element_at("meta", F.lit("category")), F.lit(default_category))
    html = fill(
        ARTICLE_HTML,
        title=shown(F.col("title")),
        author=F.lit(author),
        date=F.col("date"),
        category=shown(category),
        tags=F.when(F.size("tags") > 0, F.concat(F.lit('<div class="tags">'), spans, F.lit("</div>"))).otherwise(""),
        content=F.col("content_html"),
    )
    return df.withColumn("html", html)


def rss_item(
    df: DataFrame, author: str = DEFAULT_AUTHOR, link_base: str = DEFAULT_LINK_BASE, body: str = "body"
) -> DataFrame:
    """Add ``rss_xml``; the description is the start of the body on one line."""
    description = strip(F.translate(F.left(F.col(body), F.lit(200)), "\n", " "))
    item = fill(
        RSS_ITEM,
        title=xml_escape("title"),
        link_base=F.lit(link_base),
        slug=xml_escape("slug"),
        description=xml_escape(description),
        date=xml_escape("date"),
        author=F.lit(author),
    )
    return df.withColumn("rss_xml", item)
