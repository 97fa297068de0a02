"""The registered queries in SQL for DuckDB, written independently of the operators."""

from ..functions.seo import (
    H2_ISSUE,
    META_ISSUE,
    MISSING_KEYWORDS_ISSUE,
    NO_KEYWORDS_ISSUE,
    TITLE_ISSUE,
    WORDS_ISSUE,
)
from ..operators.render import ARTICLE_HTML, DEFAULT_AUTHOR, DEFAULT_CATEGORY, DEFAULT_LINK_BASE, RSS_ITEM
from ..sources import catalog
from . import inputs as I

SP = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NSP = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip(e: str) -> str:
    return rf"regexp_replace({e}, '\A{SP}+|{SP}+\z', '', 'g')"


def _words(e: str) -> str:
    return f"len(regexp_extract_all({e}, '{NSP}+'))"


def _unescape(e: str) -> str:
    for old, new in (
        ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&"),
    ):
        e = f"regexp_replace({e}, '{old}', '{new}', 'g')"
    return e


def _pieces(e: str) -> str:
    shown = f"regexp_replace(regexp_replace({e}, '(?s)<script.*?</script>|<style.*?</style>', '<br>', 'g'), '(?s)<!--.*?-->', '<br>', 'g')"
    split = f"string_split_regex({shown}, '(?s)<[!/?a-zA-Z][^>]*>')"
    return f"list_filter(list_transform({split}, lambda p: {_strip(_unescape('p'))}), lambda p: p <> '')"


def _text(e: str, separator: str = "chr(10)") -> str:
    return f"array_to_string({_pieces(e)}, {separator})"


def _xml(e: str) -> str:
    return f"replace(replace(replace({e}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _slug(e: str) -> str:
    kept = rf"regexp_replace({_strip(f'lower({e})')}, '[^\p{{L}}\p{{N}}_\s\x0b\x1c-\x1f\x85\p{{Z}}-]', '', 'g')"
    return rf"trim(left(regexp_replace({kept}, '[_\s\x0b\x1c-\x1f\x85\p{{Z}}]+', '-', 'g'), 60), '-')"


def _file(kind: str, e: str) -> str:
    kept = _strip(rf"regexp_replace({e}, '[^\p{{L}}\p{{N}}_\s\x0b\x1c-\x1f\x85\p{{Z}}-]', '', 'g')")
    return f"concat({kind}, '_', left(lower(regexp_replace({kept}, '{SP}+', '-', 'g')), 60), '.md')"


def _title_case(e: str) -> str:
    runs = rf"regexp_extract_all({e}, '\p{{L}}+|\P{{L}}+')"
    return f"array_to_string(list_transform({runs}, lambda r: concat(CASE left(r, 1) WHEN 'ß' THEN 'Ss' ELSE upper(left(r, 1)) END, lower(substr(r, 2)))), '')"


def _page_title(e: str = "html") -> str:
    return _strip(_unescape(f"regexp_extract({e}, '(?s)<title>(.*?)</title>', 1)"))


def _format(template: str, *values: str) -> str:
    head, tail = template.split("%d")
    return f"concat({_lit(head)}, {values[0]}, {_lit(tail)})"


ARTICLES = I.select_sql("documents", I.ARTICLES)
RESPONSES = I.select_sql("documents", I.RESPONSES)
PROCESSED = I.select_sql("documents", I.PROCESSED)
LISTING = I.select_sql("pages", I.LISTING)
PLAIN = I.select_sql("pages", I.PLAIN)
SITES = I.select_sql("pages", I.SITES)

RAW = f"""
SELECT ord, title, concat('https://example.com/', ord) AS url, body AS content,
       CASE WHEN ord % 3 > 0 THEN content_type END AS category,
       CASE WHEN ord % 2 > 0 THEN 'NFL' END AS sport, source, date
FROM ({ARTICLES})"""

ENVELOPED = f"""
SELECT ord AS key, title, url, length(content) AS n_chars, coalesce(category, 'best_bets') AS category,
       coalesce(sport, 'NBA') AS sport, source
FROM ({RAW})"""

SEO = f"""
WITH a AS ({ARTICLES}),
m AS (
  SELECT *, length(title) AS tl, length(meta_description) AS ml,
         len(regexp_extract_all(body, '(?m)^## ')) AS h2, {_words("body")} AS words,
         coalesce(len(keywords), 0) AS wanted,
         list_filter(coalesce(keywords, []), lambda k: NOT contains(lower(body), lower(k))) AS missing,
         contains(body, '{I.PLACEHOLDER}') AS linked
  FROM a),
p AS (
  SELECT *,
    CASE WHEN tl BETWEEN 30 AND 70 THEN 20 WHEN tl > 0 THEN 5 ELSE 0 END AS p_title,
    CASE WHEN ml BETWEEN 120 AND 170 THEN 20 WHEN ml > 0 THEN 5 ELSE 0 END AS p_meta,
    CASE WHEN h2 >= 2 THEN 20 ELSE least(h2 * 10, 15) END AS p_h2,
    CASE WHEN words >= 500 THEN 20 ELSE least(CAST(trunc(words / 500.0::DOUBLE * 15.0::DOUBLE) AS INT), 15) END AS p_words,
    CASE WHEN wanted = 0 OR len(missing) = 0 THEN 10
         WHEN len(missing) < wanted THEN CAST(trunc((wanted - len(missing)) / wanted::DOUBLE * 10.0::DOUBLE) AS INT)
         ELSE 0 END AS p_keywords,
    CASE WHEN linked THEN 10 ELSE 0 END AS p_link
  FROM m),
s AS (
  SELECT *, CAST(trunc((p_title + p_meta + p_h2 + p_words + p_keywords + p_link) / 100.0::DOUBLE * 100.0::DOUBLE) AS INT) AS score,
    list_filter([
      CASE WHEN NOT tl BETWEEN 30 AND 70 THEN {_format(TITLE_ISSUE, "tl")} END,
      CASE WHEN NOT ml BETWEEN 120 AND 170 THEN {_format(META_ISSUE, "ml")} END,
      CASE WHEN h2 < 2 THEN {_format(H2_ISSUE, "h2")} END,
      CASE WHEN words < 500 THEN {_format(WORDS_ISSUE, "words")} END,
      CASE WHEN len(missing) > 0 AND len(missing) = wanted THEN '{NO_KEYWORDS_ISSUE}'
           WHEN len(missing) > 0 THEN concat('{MISSING_KEYWORDS_ISSUE}', array_to_string(missing, ', ')) END,
      CASE WHEN NOT linked THEN 'Missing {I.PLACEHOLDER} placeholder' END
    ], lambda i: i IS NOT NULL) AS issue_list
  FROM p)
"""

_FRAGMENTS = """CASE source
  WHEN 'rotowire' THEN regexp_extract_all(html, '(?s)<article class="pick-card">.*?</article>')
  WHEN 'bettingpros' THEN regexp_extract_all(html, '(?s)<div class="prop-card">.*?</div>|<div class="article-card">.*?</div>')
  WHEN 'oddsshark' THEN regexp_extract_all(html, '(?s)<div class="matchup big">.*?</div>')
  ELSE regexp_extract_all(html, '(?s)<li class="article-item">.*?</li>|<article class="article-card">.*?</article>') END"""


def _inner(pattern: str) -> str:
    return _text(f"regexp_extract(f, '(?s){pattern}', 1)", "''")


def _when(pattern: str) -> str:
    return f"CASE WHEN regexp_matches(f, '(?s){pattern}') THEN {_inner(pattern)} END"


CARDS = f"""
WITH l AS ({LISTING}), x AS (SELECT *, {_FRAGMENTS} AS fs FROM l),
c AS (SELECT page_id, source, path, url, unnest(fs) AS f, generate_subscripts(fs, 1) - 1 AS pos FROM x)
SELECT page_id, source, path, url, pos,
  CASE source WHEN 'rotowire' THEN {_inner('<h1 class="pick-title">(.*?)</h1>')}
    WHEN 'bettingpros' THEN CASE WHEN starts_with(f, '<div class="prop') THEN {_inner('class="player-name">(.*?)</b>')}
                                 ELSE {_inner('<td>(.*?)</td>')} END
    WHEN 'oddsshark' THEN {_inner('class="teams">(.*?)</span>')}
    ELSE {_inner('<h2 class="headline">(.*?)</h2>')} END AS title,
  {_text("f")} AS content,
  CASE WHEN contains(f, '<a href="') THEN regexp_extract(f, '<a href="([^"]*)"', 1) END AS href,
  f AS raw_html,
  CASE source WHEN 'rotowire' THEN {_when('class="odds">(.*?)</span>')}
    WHEN 'bettingpros' THEN {_when('class="odds-value">(.*?)</td>')} END AS display,
  CASE source WHEN 'bettingpros' THEN {_when('class="over">(.*?)</span>')} END AS over,
  CAST(NULL AS VARCHAR) AS under,
  CASE source WHEN 'oddsshark' THEN {_when('class="line">(.*?)</i>')} END AS spread,
  CAST(NULL AS VARCHAR) AS total,
  CASE source WHEN 'oddsshark' THEN {_when('class="ml">(.*?)</i>')} END AS moneyline,
  CASE source WHEN 'oddsshark' THEN {_when('class="computer-pick">(.*?)</i>')} END AS computer_pick
FROM c"""

_SPORT = "CASE " + " ".join(
    f"WHEN contains(lower(path), '{s}') THEN '{s.upper()}'" for s in ("nba", "ncaab", "nfl", "mlb", "nhl")
) + " ELSE 'UNKNOWN' END"
_CATEGORY = "CASE source " + " ".join(
    f"WHEN '{s}' THEN CASE WHEN contains(path, '{m}') THEN '{hit}' ELSE '{miss}' END"
    for s, m, hit, miss in catalog.CATEGORY_RULES
) + " END"

HOST = "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)"
TITLED = f"SELECT page_id AS ord, url, {I.RAW_TITLE} AS title FROM pages"
SLUGGED = f"SELECT ord, url, title, '{I.DATE}' AS date, {_slug('title')} AS slug FROM ({TITLED})"
MANIFEST = f"SELECT slug FROM ({SLUGGED}) WHERE url LIKE 'http://%'"
UNPUBLISHED = f"""
SELECT ord, slug, title, date FROM ({SLUGGED}) s
WHERE slug NOT IN ({MANIFEST}) QUALIFY row_number() OVER (PARTITION BY slug ORDER BY ord) = 1"""

REPEATS = f"""
SELECT page_id * 10 + i AS ord, CASE i WHEN 2 THEN concat(url, '#2') ELSE url END AS url
FROM pages, (VALUES (0), (1), (2)) v(i)"""

PAGE_TITLE = _strip(_unescape(r"regexp_extract(html, '(?is)<title[^>]*>(.*?)</title\s*>', 1)"))
WITH_REPEATS = f"""
SELECT page_id * 10 + i AS ord, CASE i WHEN 2 THEN concat(url, '#2') ELSE url END AS url,
       CASE i WHEN 0 THEN title WHEN 1 THEN concat(title, 'x') ELSE left(title, greatest(length(title) - 3, 0)) END AS title
FROM (SELECT page_id, url, {PAGE_TITLE} AS title FROM pages), (VALUES (0), (1), (2)) v(i)"""

# first row per lower-case title, as all URLs differ and blank titles never match
EXACT = f"""
SELECT *, lower(title) = '' OR row_number() OVER (PARTITION BY lower(title) ORDER BY ord) = 1 AS kept
FROM ({TITLED})"""


def _matching(a: str, b: str) -> str:
    """Length of the longest block that two texts share."""
    some = lambda k: f"list_filter(range(1, length({a}) - {k} + 2), lambda i: contains({b}, substr({a}, i, {k})))"
    return f"coalesce(list_max(list_filter(range(1, least(length({a}), length({b})) + 1), lambda k: len({some('k')}) > 0)), 0)"


def _similar(titles: str, threshold: str = "0.85::DOUBLE") -> str:
    """CTEs up to ``alike(a, b)``: pairs of distinct lower-case titles ``titles(t)`` whose matching blocks reach the threshold.

    Matching blocks are found as the standard library does: the longest one, then those on either side of it. For
    titles below 200 characters, beyond which that library leaves frequent characters out.
    """
    # of blocks of one length the first in the one, then in the other
    head = "list_filter(range(1, length(sa) - k + 2), lambda i: contains(sb, substr(sa, i, k)))[1]"
    cut = "substr(sa, head, k)"
    return f"""
titles_ AS MATERIALIZED (SELECT DISTINCT t FROM ({titles}) WHERE t <> ''),
near AS MATERIALIZED (
  SELECT x.t AS a, y.t AS b, row_number() OVER () AS pair, length(x.t) + length(y.t) AS n
  FROM titles_ x JOIN titles_ y ON x.t <> y.t AND 2.0::DOUBLE * least(length(x.t), length(y.t)) >= {threshold} * (length(x.t) + length(y.t))
  WHERE levenshtein(x.t, y.t) <= n - 2 * ceil(n * {threshold} / 2 - 1e-9)),
parts(pair, sa, sb) AS (
  SELECT pair, a, b FROM near
  UNION ALL
  SELECT pair, unnest([substr(sa, 1, head - 1), substr(sa, head + k)]), unnest([substr(sb, 1, strpos(sb, {cut}) - 1), substr(sb, strpos(sb, {cut}) + k)])
  FROM (SELECT *, {head} AS head FROM (SELECT *, {_matching("sa", "sb")} AS k FROM parts WHERE sa <> '' AND sb <> '')) WHERE k > 0),
matched AS MATERIALIZED (SELECT pair, sum({_matching("sa", "sb")}) AS m FROM parts WHERE sa <> '' AND sb <> '' GROUP BY pair),
alike AS MATERIALIZED (SELECT a, b FROM near JOIN matched USING (pair) WHERE 2.0::DOUBLE * m / n >= {threshold})"""


def _one_loop(rows: str, tag: str = "") -> str:
    """CTEs up to ``kept(rn)``: ``rows(rn, title, url)`` walked through in order, from 1, against what is kept; needs ``alike``.

    ``tag`` is part of the names where there are two walks.
    """
    return f"""
rows_{tag} AS MATERIALIZED (SELECT rn, lower(coalesce(title, '')) AS t, coalesce(url, '') AS u FROM ({rows})),
blocks{tag} AS MATERIALIZED (
  SELECT rn, list_distinct(list(other)) AS others FROM (
    SELECT x.rn, y.rn AS other FROM rows_{tag} x JOIN rows_{tag} y ON x.u = y.u AND x.u <> '' AND y.rn < x.rn
    UNION ALL SELECT x.rn, y.rn FROM rows_{tag} x JOIN rows_{tag} y ON x.t = y.t AND x.t <> '' AND y.rn < x.rn
    UNION ALL SELECT x.rn, y.rn FROM rows_{tag} x JOIN alike s ON s.a = x.t JOIN rows_{tag} y ON y.t = s.b AND y.rn < x.rn) GROUP BY rn),
steps{tag} AS MATERIALIZED (SELECT rn, coalesce(others, []) AS others FROM rows_{tag} LEFT JOIN blocks{tag} USING (rn)),
walk{tag}(rn, names) AS (
  SELECT 0::BIGINT, []::BIGINT[]
  UNION ALL
  SELECT s.rn, CASE WHEN list_has_any(s.others, names) THEN names ELSE list_append(names, s.rn) END FROM walk{tag} JOIN steps{tag} s ON s.rn = walk{tag}.rn + 1),
kept{tag} AS MATERIALIZED (SELECT unnest(names) AS rn FROM walk{tag} WHERE rn = (SELECT max(rn) FROM walk{tag}))"""



_FRONT = rf"(?s)\A---{SP}*\n(.*?)\n---{SP}*\n(.*)\z"


def _flat(key: str) -> str:
    return f"""regexp_extract(block, '(?m)^{key}: *"?([^\\n]*?)"? *$', 1)"""


META = rf"""
WITH t AS ({PROCESSED}),
b AS (SELECT *, regexp_matches(text, '{_FRONT}') AS has, regexp_extract(text, '{_FRONT}', 1) AS block FROM t),
f AS (
  SELECT ord, stem, CASE WHEN has THEN regexp_extract(text, '{_FRONT}', 2) ELSE text END AS body,
    nullif({_flat("title")}, '') AS meta_title, nullif({_flat("slug")}, '') AS meta_slug,
    nullif({_flat("category")}, '') AS meta_category FROM b)
"""

_FIELDS = f"""
SELECT ord, stem, coalesce(meta_title, {_title_case("replace(stem, '-', ' ')")}) AS title,
  coalesce(meta_slug, stem) AS slug, '{I.DATE}' AS date FROM f"""

MARKED = f"""
SELECT ord, replace(replace(body, ' the ', ' **the** '), ' la ', ' *la* ') AS body FROM ({ARTICLES})"""

BLOCKS = rf"""
WITH n AS (SELECT ord, regexp_replace(replace(replace(body, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '(?m)^(#{{1,6}}[^\n]*)$', E'\n\n\\1\n\n', 'g') AS body FROM ({MARKED})),
s AS (SELECT ord, list_filter(list_transform(string_split_regex(body, '\n[ \t]*(?:\n[ \t]*)+'),
        lambda b: regexp_replace(b, '\A\n+|[\s]+\z', '', 'g')), lambda b: {_strip("b")} <> '') AS bs FROM n),
e AS (SELECT ord, unnest(bs) AS block, generate_subscripts(bs, 1) AS pos FROM s),
k AS (SELECT *, CASE WHEN regexp_matches(block, '\A#{{1,6}}') THEN 'heading'
    WHEN regexp_matches(block, '\A {{0,3}}(?:(?:\*[ \t]*){{3,}}|(?:-[ \t]*){{3,}}|(?:_[ \t]*){{3,}})\z') THEN 'rule'
    WHEN regexp_matches(block, '\A {{0,3}}[*+-][ \t]+') THEN 'ul'
    WHEN regexp_matches(block, '\A {{0,3}}\d+\.[ \t]+') THEN 'ol' ELSE 'p' END AS kind FROM e),
h AS (SELECT *, CASE WHEN kind = 'heading' THEN length(regexp_extract(block, '\A(#{{1,6}})', 1)) ELSE 0 END AS level,
    CASE WHEN kind = 'heading' THEN regexp_extract(block, '\A(#{{1,6}})[ \t]*(.*?)[ \t]*#*\s*\z', 2) ELSE block END AS inner_text FROM k)
"""


def _inline(e: str) -> str:
    e = _xml(e)
    for pattern, new in (
        (r"`([^`\n]+)`", r"<code>\1</code>"),
        (r"\[([^\]\n]+)\]\(([^)\s]+)\)", r'<a href="\2">\1</a>'),
        (r"\*\*(\S(?:[^\n]*?\S)?)\*\*", r"<strong>\1</strong>"),
        (r"\*([^\s*](?:[^*\n]*[^\s*])?)\*", r"<em>\1</em>"),
    ):
        e = f"regexp_replace({e}, '{pattern}', '{new}', 'g')"
    return e


FORMATTED = f"""
SELECT ord, title, date, {_slug("title")} AS slug, body, meta_description, lang,
  CASE WHEN ord % 2 = 0 THEN lang ELSE '{DEFAULT_CATEGORY}' END AS category,
  CASE WHEN ord % 2 = 0 THEN meta_description ELSE '' END AS summary,
  coalesce(keywords, []) AS tags, concat('<p>', meta_description, '</p>') AS content_html
FROM ({ARTICLES})"""

_TAGS = """CASE WHEN len(tags) > 0 THEN concat('<div class="tags">', array_to_string(list_transform(tags,
  lambda t: concat('<span class="tag">', t, '</span>')), ''), '</div>') ELSE '' END"""


def _filled(template: str, **fields: str) -> str:
    out = _lit(template)
    for name, expr in fields.items():
        out = out.replace("{" + name + "}", f"', {expr}, '")
    return f"concat({out})"


_HTML = _filled(
    ARTICLE_HTML, title="title", author=_lit(DEFAULT_AUTHOR), date="date", category="category",
    tags=_TAGS.replace("\n", " "), content="content_html",
)
_RSS = _filled(
    RSS_ITEM, title=_xml("title"), link_base=_lit(DEFAULT_LINK_BASE), slug=_xml("slug"),
    description=_xml(_strip("replace(left(body, 200), chr(10), ' ')")), date=_xml("date"), author=_lit(DEFAULT_AUTHOR),
)

_OUTCOME = (
    "CASE page_id % 6 WHEN 0 THEN 'published' WHEN 1 THEN 'published' WHEN 2 THEN 'auth failed' "
    "WHEN 3 THEN 'collection not found' WHEN 4 THEN 'rate limit exceeded' ELSE 'error' END"
)
_STATUS = "CASE page_id % 6 WHEN 0 THEN 202 WHEN 1 THEN 201 WHEN 2 THEN 401 WHEN 3 THEN 404 WHEN 4 THEN 429 ELSE 500 END"


def _label(name: str) -> str:
    return f"trim({_strip(rf'''regexp_extract(response, '(?m)^{name}:{SP}*(.+)$', 1)''')}, '\"')"


_PARSED = rf"""{_label("TITLE")} AS title, {_label("META_DESCRIPTION")} AS meta_description,
  {_strip(rf"regexp_extract(response, '(?ms)^BODY:{SP}*\n(.*)', 1)")} AS body"""

_MERGED = "coalesce(keywords, []) || list_filter(['prediction markets'], lambda k: NOT list_contains(coalesce(keywords, []), k))"

FILES = f"""
SELECT ord, date, {_file("content_type", "title")} AS output_file, title FROM ({ARTICLES})"""

MARKDOWN = SEO + f""", d AS (
SELECT ord, date, title, concat('---', chr(10), 'title: "', title, '"', chr(10), 'meta_description: "', meta_description, '"', chr(10),
  'category: "', content_type, '"', chr(10), 'sport: "', sport, '"', chr(10), 'source: "', source, '"', chr(10),
  'date: "', date, '"', chr(10), 'keywords: ', concat('[', array_to_string(list_transform(coalesce(keywords, []), lambda k: concat('"', k, '"')), ', '), ']'), chr(10),
  'seo_score: ', score, chr(10), '---', chr(10), chr(10), body) AS markdown, {_file("content_type", "title")} AS output_file
FROM s)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    page = f"""
WITH f AS (SELECT page_id, {_page_title()} AS title, {_text("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")} AS content FROM pages)"""
    q["page_fields"] = page + " SELECT * FROM f"
    q["worth_publishing"] = (
        SEO.replace(f"WITH a AS ({ARTICLES})", page + """,
a AS (SELECT page_id, title, content AS body, left(replace(content, chr(10), ' '), 160) AS meta_description,
      ['the', 'and'] AS keywords FROM f)""")
        + f""", g AS (SELECT page_id, title, {_slug("title")} AS slug, score, score >= 70 AS passed,
  array_to_string(issue_list, '|') AS issues FROM s)
SELECT * FROM g WHERE slug <> '' QUALIFY row_number() OVER (PARTITION BY slug ORDER BY page_id) = 1"""
    )

    q["pages_of_sites"] = f"""
SELECT page_id, {HOST} AS source, concat('https://', {HOST}) AS base_url,
  regexp_replace(url, '^[a-z]+://[^/?#]*', '') AS path, length(html) AS n_chars
FROM pages WHERE {HOST} IN (SELECT {HOST} FROM pages WHERE url LIKE 'https://%')"""
    q["explode_envelope"] = ENVELOPED
    q["raw_envelope_round_trip"] = f"SELECT title, url, n_chars, category, sport, source FROM ({ENVELOPED})"
    q["raw_records_round_trip"] = f"SELECT title, url, length(content) AS n_chars, category, sport FROM ({RAW})"
    q["raw_day"] = f"""
SELECT source, count(*) AS records, CAST(sum(length(content)) AS BIGINT) AS n_chars FROM ({RAW}) WHERE ord % 3 = 0 GROUP BY source"""
    q["missing_sites"] = """
SELECT DISTINCT source FROM (SELECT source FROM documents UNION SELECT concat(source, lang) FROM documents)
WHERE source NOT IN (SELECT source FROM documents WHERE lang = 'es')"""
    q["processed_round_trip"] = MARKDOWN + f"""
SELECT date, regexp_replace(output_file, '\\.md$', '') AS stem, md5(markdown) AS text_md5
FROM d WHERE {_strip("title")} <> '' QUALIFY row_number() OVER (PARTITION BY output_file ORDER BY ord DESC) = 1"""
    q["publish_round_trip"] = META + f""",
g AS ({_FIELDS}),
one AS (SELECT * FROM g WHERE ord % 2 = 0 QUALIFY row_number() OVER (PARTITION BY slug ORDER BY ord) = 1),
two AS (SELECT * FROM g WHERE slug NOT IN (SELECT slug FROM one) QUALIFY row_number() OVER (PARTITION BY slug ORDER BY ord) = 1)
SELECT slug, title, date, 'first' AS batch_id FROM one UNION ALL SELECT slug, title, date, 'second' FROM two"""
    q["split_rejects"] = """
SELECT page_id, CASE WHEN length(html) < 1000 THEN 'page too short' WHEN NOT ends_with(html, '</html>') THEN 'page cut off' ELSE 'ok' END AS result
FROM pages"""

    q["extract_cards"] = f"SELECT * EXCLUDE (source, path, url) FROM ({CARDS})"
    q["extract_records"] = f"""
SELECT source, page_id, pos,
  CASE WHEN source = 'bettingpros' THEN url WHEN href LIKE '/%' THEN concat('https://www.', source, '.com', href)
       WHEN href LIKE 'http%' THEN href ELSE url END AS url,
  {_CATEGORY} AS category, {_SPORT} AS sport, href IS NOT NULL AND source <> 'bettingpros' AS needs_full_scrape
FROM ({CARDS})"""
    q["extract_fallback"] = f"""
WITH p AS ({PLAIN}), f AS (SELECT page_id, html, CASE page_id % 3 WHEN 1 THEN regexp_extract(html, '(?s)<main>.*?</main>')
  ELSE regexp_extract(html, '(?s)<div class="wide main-content">.*?</div>') END AS raw_html FROM p WHERE page_id % 3 > 0)
SELECT page_id, 0 AS pos, {_page_title()} AS title, {_text("raw_html")} AS content, raw_html, 0 AS n_odds FROM f"""
    q["extract_body"] = f"""
WITH f AS (SELECT page_id, regexp_extract(html, '(?s)<article>.*?</article>') AS f FROM pages)
SELECT page_id, {_text("f")} AS content, length(f) AS n_raw FROM f"""
    q["enrich_linked"] = f"""
WITH a AS (SELECT page_id AS ord, {HOST} AS source, html, page_id % 3 > 0 AS flag FROM pages),
b AS (SELECT *, regexp_extract(html, '(?s)<article>.*?</article>') AS f FROM a)
SELECT ord, source, md5(CASE WHEN flag THEN {_text("f")} ELSE left(html, 40) END) AS content_md5,
  CASE WHEN flag THEN length(f) ELSE 0 END AS n_raw FROM b"""
    q["sport_counts"] = f"SELECT {_SPORT} AS sport, count(*) AS records FROM ({LISTING}) GROUP BY 1"

    q["seed_urls"] = f"""
WITH s AS ({SITES}), e AS (SELECT source, base_url, unnest(paths) AS path, generate_subscripts(paths, 1) - 1 AS pos FROM s)
SELECT source, pos, path, concat(base_url, path) AS url FROM e"""
    q["select_sites"] = f"SELECT source, base_url FROM ({SITES}) WHERE source IN (SELECT CAST(doc_id AS VARCHAR) FROM documents)"
    q["unknown_sites"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS source FROM documents WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT source FROM ({SITES}))"""
    q["robots_allowed"] = rf"""
WITH u AS (SELECT page_id, {HOST} AS host, regexp_replace(url, '^[a-z]+://[^/?#]*', '') AS path FROM pages)
SELECT page_id, host,
  CASE WHEN host LIKE 'blog.%' THEN NOT starts_with(path, '/fr/')
       WHEN host LIKE 'm.%' THEN true
       ELSE starts_with(path, '/en/7') OR NOT starts_with(path, '/en/') END AS allowed FROM u"""

    q["dedup_exact"] = f"SELECT ord, url, title FROM ({EXACT}) WHERE kept"
    q["dedup_counts"] = f"SELECT count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS removed FROM ({EXACT})"
    # a title and the same title with one more letter share all its characters
    q["title_similarity"] = f"""
SELECT ord, 2.0::DOUBLE * length(title) / (2 * length(title) + 1) AS ratio FROM ({TITLED})"""
    q["repeated_urls"] = f"""
SELECT ord, first_ord, url FROM (SELECT ord, url, min(ord) OVER (PARTITION BY url) AS first_ord FROM ({REPEATS})) WHERE ord > first_ord"""
    q["similar_title_pairs"] = f"""
WITH RECURSIVE r AS ({WITH_REPEATS}), first AS (SELECT lower(title) AS t, min(ord) AS ord FROM r GROUP BY 1), {_similar("SELECT lower(title) AS t FROM r")}
SELECT a AS title, b AS earlier_title FROM alike JOIN first x ON x.t = a JOIN first y ON y.t = b WHERE y.ord < x.ord"""
    q["dedup_fuzzy"] = f"""
WITH RECURSIVE r AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY ord) AS rn FROM ({WITH_REPEATS})), {_similar("SELECT lower(title) AS t FROM r")},
{_one_loop("SELECT * FROM r")}
SELECT ord, url, title FROM r JOIN kept USING (rn)"""
    q["records_per_source"] = "SELECT source, count(*) AS records FROM documents GROUP BY source"

    q["merge_keywords"] = f"""
SELECT ord, array_to_string(coalesce(keywords, []) || list_filter(['and', 'prediction markets'],
  lambda k: NOT list_contains(coalesce(keywords, []), k)), '|') AS keywords FROM ({ARTICLES})"""
    q["build_prompt"] = f"""
WITH a AS ({ARTICLES})
SELECT ord, concat(lang, ': Write about ', sport, ' on {I.DATE} in {{one}} go.', chr(10),
  CAST(to_json({{'content_type': content_type, 'title': title, 'content': body, 'sport': sport, 'source': source}}) AS VARCHAR), chr(10),
  'Use ', array_to_string({_MERGED}, ', '), '; {I.PLACEHOLDER}') AS prompt FROM a WHERE lang <> 'es'"""
    q["unknown_content_type"] = f"""
SELECT ord, content_type, 'Unknown content type, must be one of: {", ".join(catalog.CONTENT_TYPES)}' AS error
FROM ({ARTICLES}) WHERE lang = 'es'"""
    q["parse_response"] = f"""
SELECT article_id, {_PARSED} FROM ({RESPONSES} UNION ALL
  SELECT -conv_id * 100 - turn, text FROM conversations)"""
    q["assemble_articles"] = f"""
WITH r AS ({RESPONSES}), a AS ({ARTICLES})
SELECT article_id, {_PARSED.replace("AS title", "AS title").replace("response,", "r.response,")}, content_type,
  'NBA' AS sport, CASE WHEN ord % 3 > 0 THEN source ELSE 'unknown' END AS source, '{I.DATE}' AS date,
  array_to_string(coalesce(keywords, []), '|') AS keywords
FROM r JOIN a ON r.article_id = a.ord WHERE response <> ''"""

    q["seo_score"] = SEO + """
SELECT ord, p_title, p_meta, p_h2, p_words, p_keywords, p_link, score, score >= 70 AS passed,
  array_to_string(issue_list, '|') AS issues FROM s"""
    q["seo_summary"] = SEO + """
SELECT ord, concat('SEO ', CASE WHEN score >= 70 THEN 'PASS' ELSE 'FAIL' END, ' (score: ', score, '/100)',
  array_to_string(list_transform(issue_list, lambda i: concat(chr(10), '  - ', i)), '')) AS summary FROM s"""
    q["seo_report"] = SEO + """
SELECT source, content_type, CAST(sum(CASE WHEN score >= 70 THEN 1 ELSE 0 END) AS BIGINT) AS passed, count(*) AS total
FROM s GROUP BY ROLLUP (source, content_type)"""

    q["frontmatter"] = MARKDOWN + " SELECT ord, markdown, output_file FROM d"
    q["safe_filename"] = f"SELECT ord, output_file AS file FROM ({FILES})"
    q["slugify"] = f"SELECT ord, {_slug('meta_description')} AS slug FROM ({ARTICLES})"
    q["title_case"] = f"SELECT ord, {_title_case('title')} AS title FROM ({ARTICLES})"
    split = META + """
SELECT ord, meta_title, meta_slug, meta_category,
  (meta_title IS NOT NULL)::INT + (meta_slug IS NOT NULL)::INT + (meta_category IS NOT NULL)::INT AS n_meta, md5(body) AS body_md5 FROM f"""
    q["split_frontmatter"] = split
    q["split_frontmatter_yaml"] = split
    q["frontmatter_lists"] = """
SELECT doc_id AS ord, CASE WHEN good THEN concat('Doc ', chr(39), lang, chr(39)) END AS title, CASE WHEN good THEN concat('doc-', doc_id) END AS slug,
  CASE WHEN good THEN concat(lang, '|', source, ': x') ELSE '' END AS tags, md5(text) AS body_md5, NOT good AS rejected
FROM (SELECT *, doc_id % 5 <> 4 AS good FROM documents)"""
    item, out = "concat('<li>', {}, '</li>', chr(10))".format, "concat('<{0}l>', chr(10), {1}, '</{0}l>', chr(10))".format
    inner = out("u", f"concat({item('doc_id')}, {item(_lit('x'))})")
    middle = out("o", f"concat('<li>', source, {inner}, '</li>', chr(10), {item("concat('<strong>', lang, '</strong>')")})")
    outer = f"concat('<li>', lang, {middle}, '</li>', chr(10), CASE WHEN doc_id % 2 = 0 THEN {item('source')} ELSE '' END)"
    quote = "concat('<blockquote>', chr(10), '<p>', {}, '</p>', chr(10), {}, '</blockquote>')".format
    deep = quote("lang", "concat('<blockquote>', chr(10), '<p>', doc_id, '</p>', chr(10), '</blockquote>', chr(10))")
    q["nested_markdown"] = f"""
SELECT doc_id AS ord, concat({out("u", outer)}, {quote("source", f"concat({deep}, chr(10))")}) AS content_html FROM documents"""
    q["article_fields"] = META + f"SELECT ord, title, slug, date FROM ({_FIELDS})"
    q["markdown_blocks"] = BLOCKS + """
SELECT kind, level, count(*) AS blocks, CAST(sum(length(inner_text)) AS BIGINT) AS n_chars FROM h GROUP BY ALL"""
    q["render_markdown"] = BLOCKS + rf"""
, r AS (SELECT ord, pos, CASE kind
    WHEN 'heading' THEN concat('<h', level, '>', {_inline("inner_text")}, '</h', level, '>')
    WHEN 'rule' THEN '<hr />'
    ELSE concat('<p>', {_inline("regexp_replace(block, '^[ \t]+', '')")}, '</p>') END AS html FROM h)
SELECT ord, coalesce(string_agg(html, chr(10) ORDER BY pos), '') AS content_html FROM r GROUP BY ord"""
    q["wrap_html"] = f"SELECT ord, {_HTML} AS html FROM ({FORMATTED})"
    q["rss_item"] = f"SELECT ord, {_RSS} AS rss_xml FROM ({FORMATTED})"
    q["last_per_path"] = f"""
SELECT {_file("content_type", "left(title, 4)")} AS output_file, max(ord) AS ord FROM ({ARTICLES}) GROUP BY 1"""

    q["unpublished"] = f"SELECT ord, slug FROM ({UNPUBLISHED})"
    q["published_flag"] = f"SELECT ord, slug, slug IN ({MANIFEST}) AS published FROM ({SLUGGED})"
    q["manifest_rows"] = f"""
SELECT slug, title, date, concat('out/published/', date, '/', slug, '.html') AS path FROM ({UNPUBLISHED})"""
    q["cms_payload"] = f"""
SELECT ord, 'true' AS is_draft, 'false' AS is_archived, title AS name, slug, summary, category, date,
  '{DEFAULT_AUTHOR}' AS author, length({_HTML}) AS n_body FROM ({FORMATTED})"""
    q["publish_outcomes"] = f"""
SELECT CAST(page_id AS VARCHAR) AS slug, '{I.DATE}' AS date, {_STATUS} AS status, {_OUTCOME} AS outcome,
  CASE WHEN page_id % 6 < 2 THEN concat('item-', page_id) END AS external_id,
  CASE WHEN page_id % 6 < 2 THEN true END AS is_draft,
  CASE WHEN page_id % 6 >= 2 THEN left(html, 500) END AS message FROM pages"""
    q["outcome_manifest"] = f"""
SELECT CAST(page_id AS VARCHAR) AS slug, '{I.DATE}' AS date, concat('item-', page_id) AS external_id, false AS is_draft
FROM pages WHERE page_id % 6 < 2"""

    # files are taken by source, then in the order of their articles
    q["incremental_run"] = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT *, ord % 3 = 1 AS later, row_number() OVER (ORDER BY ord % 3 = 1, source, ord) AS rn FROM ({RAW})),
{_similar("SELECT lower(title) AS t FROM w")}, {_one_loop("SELECT * FROM w")},
r AS (SELECT later, coalesce(category, 'best_bets') AS kind,
    concat('TITLE: ', title, chr(10), 'META_DESCRIPTION: ', left(content, 20), chr(10), 'BODY:', chr(10), content) AS response
  FROM w JOIN kept USING (rn)),
p AS (SELECT later, kind, {_PARSED} FROM r),
f AS (SELECT *, regexp_replace({_file("kind", "title")}, '\\.md$', '') AS slug FROM p WHERE {_strip("title")} <> '')
SELECT slug, '{I.DATE}' AS date, concat('batch-00000000000', min(later::INT)) AS batch_id FROM f GROUP BY slug"""
    q["incremental_reread"] = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY source, ord) AS rn FROM ({RAW}) WHERE ord % 3 <> 1),
{_similar(f"SELECT lower(title) AS t FROM ({RAW})")}, {_one_loop("SELECT * FROM w")},
other AS (SELECT min(source) AS source FROM ({RAW})),
-- what stays comes first, then repeats, which may come again, then the new articles
n AS (SELECT title, url, source, ord, CASE WHEN kept.rn IS NULL THEN 1 ELSE 0 END AS turn FROM w LEFT JOIN kept USING (rn)
      WHERE source <> (SELECT source FROM other)
      UNION ALL SELECT title, url, source, ord, 2 FROM ({RAW}) WHERE ord % 3 = 1 AND source = (SELECT source FROM other)),
v AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY turn, source, ord) AS rn FROM n), {_one_loop("SELECT * FROM v", "2")}
SELECT title, url, source FROM v JOIN kept2 USING (rn)"""
    q["envelope_order"] = f"""
SELECT title, url FROM ({RAW}) QUALIFY row_number() OVER (PARTITION BY title ORDER BY ord) = 1"""
    last = "row_number() OVER (PARTITION BY output_file ORDER BY ord DESC) = 1"
    q["rerun_same_day"] = MARKDOWN + f""",
k AS (SELECT *, regexp_replace(output_file, '\\.md$', '') AS slug FROM d WHERE {_strip("title")} <> ''),
one AS (SELECT * FROM k WHERE ord % 3 > 0 QUALIFY {last}),
two AS (SELECT * FROM k WHERE ord % 3 < 2 QUALIFY {last})
SELECT slug, CASE WHEN one.slug IS NULL THEN 'day~0002' ELSE 'day' END AS batch_id, true AS has_html,
  md5(coalesce(two.markdown, one.markdown)) AS text_md5
FROM one FULL JOIN two USING (slug)"""
    return q
