"""Inputs of the registered queries, derived from the test tables.

Each input is a list of ``(column, expression)`` in SQL that Spark and DuckDB
read alike, so that both sides of a comparison start from the same rows.
"""

from pyspark.sql import DataFrame, SparkSession

NL = "chr(10)"
DATE = "2026-01-01"
PLACEHOLDER = "{{internal_link}}"
DEFAULT_KEYWORDS = ("prediction markets",)

CONTENT_TYPE = (
    "CASE lang WHEN 'en' THEN 'best_bets' WHEN 'de' THEN 'player_props' "
    "WHEN 'fr' THEN 'odds_analysis' ELSE 'predictions' END"
)
TITLE = f"left(split_part(text, {NL}, 1), 80)"
META = f"left(replace(text, {NL}, ' '), 160)"

ARTICLES = [
    ("ord", "doc_id"),
    ("title", TITLE),
    ("meta_description", META),
    (
        "body",
        f"CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN concat('## a', {NL}, {NL}, text) "
        f"ELSE concat('## a', {NL}, {NL}, text, {NL}, {NL}, '## b', {NL}, {NL}, '{PLACEHOLDER}') END",
    ),
    ("keywords", "CASE WHEN doc_id % 5 > 0 THEN split(CASE WHEN doc_id % 2 = 0 THEN 'the,and' ELSE 'la,der,of' END, ',') END"),
    ("content_type", CONTENT_TYPE),
    ("sport", "'NBA'"),
    ("source", "source"),
    ("lang", "lang"),
    ("date", f"'{DATE}'"),
]

# one response per document; a section is missing in some of them
RESPONSES = [
    ("article_id", "doc_id"),
    (
        "response",
        f"concat(CASE WHEN doc_id % 7 = 1 THEN '' ELSE concat('TITLE: \"', {TITLE}, '\"', {NL}) END, "
        f"CASE WHEN doc_id % 7 = 2 THEN '' ELSE concat('META_DESCRIPTION: ', {META}, {NL}) END, "
        f"CASE WHEN doc_id % 7 = 3 THEN '' ELSE concat('BODY:', {NL}, text) END)",
    ),
]

PROCESSED = [
    ("ord", "doc_id"),
    ("stem", "concat('best_bets_item-', CAST(doc_id AS STRING))"),
    (
        "text",
        f"CASE WHEN doc_id % 4 = 0 THEN text ELSE concat('---', {NL}, "
        f"CASE WHEN doc_id % 4 = 1 THEN '' ELSE concat('title: \"Doc ', CAST(doc_id AS STRING), '\"', {NL}) END, "
        f"'slug: \"doc-', CAST(doc_id % 700 AS STRING), '\"', {NL}, 'category: ', lang, {NL}, "
        f"'---', {NL}, text) END",
    ),
]

#: Front matter with quoted scalars, remarks and lists, above the text of every document; of every fifth with a mapping inside.
LISTED = [
    ("ord", "doc_id"),
    (
        "text",
        f"concat('---', {NL}, 'title: ', chr(39), 'Doc ', chr(39), chr(39), lang, chr(39), chr(39), chr(39), {NL}, '# a remark', {NL}, "
        f"'slug: doc-', CAST(doc_id AS STRING), ' # here', {NL}, "
        f"'tags:', {NL}, '  - ', lang, {NL}, '  - \"', source, ': x\"', {NL}, 'keywords: [', lang, ', \"a, b\"]', {NL}, "
        f"CASE WHEN doc_id % 5 = 4 THEN concat('seo:', {NL}, '  score: 7', {NL}) ELSE '' END, '---', {NL}, text)",
    ),
]

#: Lists and quotes inside one another, to three levels.
NESTED = [
    ("ord", "doc_id"),
    (
        "body",
        f"concat('- ', lang, {NL}, '    1. ', source, {NL}, '        * ', CAST(doc_id AS STRING), {NL}, '        * x', {NL}, "
        f"'    2. **', lang, '**', {NL}, CASE WHEN doc_id % 2 = 0 THEN concat('- ', source, {NL}) ELSE '' END, {NL}, "
        f"'> ', source, {NL}, '>', {NL}, '> > ', lang, {NL}, '> >', {NL}, '> > > ', CAST(doc_id AS STRING))",
    ),
]

_MATCHUP = (
    '<div class="matchup big"><span class="teams">A @ <b>B</b></span><i class="line">-3.5</i>'
    '<i class="ml">+120</i><i class="computer-pick">A</i><a href="http://odds.example.com/m">m</a>'
)
_FIRST_CELL = '<table><tr><td>First</td><td class="odds-value">-110</td></tr></table><h1>'
_PROP = '<div class="prop-card"><span class="over">o1</span><b class="player-name">'


def _replace(expr: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, '{old}', {new})"
    return expr


def _quoted(text: str) -> str:
    return f"'{text}'"


SOURCE = (
    "CASE page_id % 4 WHEN 0 THEN 'rotowire' WHEN 1 THEN 'bettingpros' WHEN 2 THEN 'oddsshark' ELSE 'covers' END"
)
PATH = (
    "concat('/', CASE page_id % 7 WHEN 0 THEN 'nba' WHEN 1 THEN 'ncaab' WHEN 2 THEN 'nfl' WHEN 3 THEN 'mlb' "
    "WHEN 4 THEN 'nhl' WHEN 5 THEN 'WNBA' ELSE 'golf' END, '/', CASE page_id % 5 WHEN 0 THEN 'player-props' "
    "WHEN 1 THEN 'odds' WHEN 2 THEN 'computer-picks' WHEN 3 THEN 'best-bets' ELSE 'betting-news' END)"
)
LISTING_HTML = "CASE page_id % 4 WHEN 0 THEN {} WHEN 1 THEN {} WHEN 2 THEN {} ELSE {} END".format(
    _replace(
        "html",
        ("<article>", _quoted('<article class="pick-card">')),
        (
            "<h1>",
            "concat('<a href=\"/pick/', CAST(page_id AS STRING), '\">More</a><span class=\"odds\">+', "
            "CAST(page_id AS STRING), '</span><h1 class=\"pick-title\">')",
        ),
    ),
    _replace(
        "html",
        ("<li>", _quoted(_PROP)),
        ("</li>", _quoted("</b></div>")),
        ("<article>", _quoted('<div class="article-card">')),
        ("</article>", _quoted("</div>")),
        ("<h1>", _quoted(_FIRST_CELL)),
    ),
    _replace("html", ("<article>", _quoted(_MATCHUP)), ("</article>", _quoted("</div>"))),
    _replace(
        "html",
        ("<li>", _quoted('<li class="article-item">')),
        ("<article>", _quoted('<article class="article-card">')),
        ("<h1>", _quoted('<h2 class="headline">')),
        ("</h1>", _quoted("</h2>")),
    ),
)

#: Listing pages with cards of all four sites.
LISTING = [
    ("page_id", "page_id"),
    ("source", SOURCE),
    ("path", PATH),
    ("url", f"concat('https://www.', {SOURCE}, '.com', {PATH}, '?p=', CAST(page_id AS STRING))"),
    ("html", LISTING_HTML),
]

#: Pages without cards; every third has no main area either.
PLAIN = [
    ("page_id", "page_id"),
    ("source", SOURCE),
    ("url", "url"),
    (
        "html",
        "CASE page_id % 3 WHEN 0 THEN html WHEN 1 THEN {} ELSE {} END".format(
            _replace("html", ("<article>", _quoted("<main>")), ("</article>", _quoted("</main>"))),
            _replace(
                "html",
                ("<article>", _quoted('<div class="wide main-content">')),
                ("</article>", _quoted("</div>")),
            ),
        ),
    ),
]

RAW_TITLE = "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"
HOST = "regexp_extract(url, '^[a-z]+://([^/]+)', 1)"

#: One crawl site per page: its host with three entry paths.
SITES = [
    ("source", "CAST(page_id AS STRING)"),
    ("base_url", f"concat('https://', {HOST})"),
    ("paths", f"split(concat('/,/', substr({HOST}, 1, 4), '/odds,/page/', CAST(page_id AS STRING)), ',')"),
]


def derive(spark: SparkSession, sf_dir: str, table: str, columns) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns])


def select_sql(table: str, columns, extra: str = "") -> str:
    return "SELECT " + ", ".join(f"{expr} AS {name}" for name, expr in columns) + f"{extra} FROM {table}"
