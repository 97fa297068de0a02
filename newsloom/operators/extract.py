"""One record per card of a listing page, driven by the rule table."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.selectors import Page, parse_selector
from ..functions.urls import path_of, resolve_link, sport_from_path
from ..schemas import CARD, STR
from ..sources.catalog import ARTICLE_BODY_SEL, DEFAULT_CONTENT_TYPE
from .skew import small

#: ``class`` or ``id`` written with a character reference cannot be searched literally.
_ENCODED_NAME = r"(?i)\b(?:class|id)\s*=\s*(?:\"[^\"]*&|'[^']*&|[^\s\"'>]*&)"


#: Characters of pages that Python turns into objects at once; a longer page stands alone.
SLICE_BYTES = 2_000_000
_BODY = T.StructType([T.StructField("content", STR), T.StructField("raw_html", STR)])


def _ends(html: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes of pages."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(html), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(sizes):
        before = int(sizes[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield at, end
        at = end


def _in_slices(
    batches: Iterator[tuple[pa.Array, ...]], read: Callable[..., list], kind: T.DataType, most: int
) -> Iterator[pa.Array]:
    """``read`` of every row. What is read leaves the task slice by slice, however many pages a batch has."""
    arrow = to_arrow_type(kind)
    for columns in batches:
        empty = True
        for at, end in _ends(columns[0], most):
            empty = False
            rows = zip(*(c.slice(at, end - at).to_pylist() for c in columns))
            yield pa.array([read(*row) for row in rows], type=arrow)
        if empty:
            yield pa.array([], type=arrow)


def _page_title(page: Page) -> str:
    return page.text(page.first("title"), "")


def _cards(html: str, card_sel: str, title_sel: str, fallback_sel: str, odds_sel: dict) -> list[dict]:
    page = Page(html)
    out = []
    for card in page.select(card_sel):
        link = page.first("a[href]", card)
        odds = {}
        for key, selector in odds_sel.items():
            found = page.first(selector, card)
            if found is not None:
                odds[key] = page.text(found, "")
        out.append(
            {
                "title": page.text(page.first(title_sel, card), ""),
                "content": page.text(card, "\n"),
                "href": None if link is None else link.attrs["href"] or "",
                "odds_data": list(odds.items()),
                "raw_html": page.source(card),
                "fallback": False,
            }
        )
    if out:
        return out
    main = page.first(fallback_sel)
    if main is None:
        return []
    return [
        {
            "title": _page_title(page),
            "content": page.text(main, "\n"),
            "href": None,
            "odds_data": [],
            "raw_html": page.source(main),
            "fallback": True,
        }
    ]


def _card_reader(most: int):
    kind = T.ArrayType(CARD)

    def read(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return _in_slices(batches, lambda h, c, t, f, o: _cards(h, c, t, f, dict(o)), kind, most)

    return F.arrow_udf(read, kind)


def _may_match(html: Column, selectors: Column) -> Column:
    """False only for pages on which no selector can match.

    A class or id must occur literally in the source, a bare tag as ``<tag``;
    the check keeps such pages out of Python.
    """
    parts = F.transform(F.split(selectors, ","), lambda s: F.trim(s))
    names = F.transform(
        parts,
        lambda s: F.coalesce(
            F.nullif(F.regexp_extract(s, r"[.#]([\w-]+)", 1), F.lit("")),
            F.concat(F.lit("<"), F.regexp_extract(s, r"^([a-z][a-z0-9-]*)", 1)),
        ),
    )
    low = F.lower(html)
    return F.exists(names, lambda n: F.contains(low, F.lower(n))) | F.rlike(html, F.lit(_ENCODED_NAME))


def extract_cards(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages(page_id, url, html, source, …)`` to one row per card, in page order.

    A page without cards gives one row from its main area, a page without that
    gives none. Adds ``pos`` and the card fields; ``html`` is dropped.
    """
    joined = pages.where(F.col("html").isNotNull()).join(small(rules), "source")
    joined = joined.where(_may_match(F.col("html"), F.concat_ws(",", "card_sel", "fallback_sel")))
    read = _card_reader(SLICE_BYTES)
    keep = [c for c in pages.columns if c != "html"] + ["resolve_links"]
    return joined.select(
        *keep,
        F.posexplode(
            read("html", "card_sel", "title_sel", "fallback_sel", F.coalesce("odds", F.create_map().cast("map<string,string>")))
        ).alias("pos", "card"),
    ).select(*keep, "pos", "card.*")


def without_rule(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Thin rows of pages whose source has no extraction rule, with ``error``."""
    left = pages.join(small(rules.select("source")), "source", "left_anti")
    return left.select("source", "page_id", "url").withColumn("error", F.lit("no rule for this source"))


def category_from_path(path, marker, hit, miss) -> Column:
    return F.when(F.contains(path, marker), hit).otherwise(miss)


def extract_records(
    pages: DataFrame, rules: DataFrame, sites: DataFrame, category_rules: DataFrame
) -> DataFrame:
    """Article rows of listing pages.

    ``pages`` may carry ``path`` (the entry path of the crawl); otherwise it is
    taken from the URL. ``needs_full_scrape`` marks cards with any link.
    """
    if "path" not in pages.columns:
        pages = pages.withColumn("path", path_of("url"))
    cards = extract_cards(pages, rules).withColumnRenamed("url", "page_url")
    linked = resolve_link("href", "base_url", "page_url")
    return (
        cards.join(small(sites.select("source", "base_url")), "source")
        .join(small(category_rules), "source", "left")
        .select(
            "source",
            "page_id",
            "pos",
            "title",
            F.when(F.col("resolve_links"), linked).otherwise(F.col("page_url")).alias("url"),
            "content",
            F.coalesce(
                category_from_path(F.col("path"), F.col("marker"), F.col("hit"), F.col("miss")),
                F.lit(DEFAULT_CONTENT_TYPE),
            ).alias("category"),
            sport_from_path("path").alias("sport"),
            "odds_data",
            "raw_html",
            (F.col("href").isNotNull() & F.col("resolve_links")).alias("needs_full_scrape"),
        )
    )


def _first_match(selector: str, most: int):
    parse_selector(selector)
    kind = T.ArrayType(_BODY)

    def body(html: str) -> list[dict]:
        page = Page(html)
        e = page.first(selector)
        return [] if e is None else [{"content": page.text(e, "\n"), "raw_html": page.source(e)}]

    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _in_slices(((html,) for html in batches), body, kind, most)

    return F.arrow_udf(read, kind)


def extract_body(pages: DataFrame, selector: str = ARTICLE_BODY_SEL) -> DataFrame:
    """Text and source of the first article body of each page; pages without one are dropped."""
    wanted = pages.where(F.col("html").isNotNull() & _may_match(F.col("html"), F.lit(selector)))
    keep = [c for c in pages.columns if c != "html"]
    # at most one element: a filter on the result would read every page twice
    found = wanted.select(*keep, F.explode(_first_match(selector, SLICE_BYTES)("html")).alias("body"))
    return found.select(*keep, "body.content", "body.raw_html")
