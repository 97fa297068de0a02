"""Built-in site definitions, extraction rules and prompt templates.

All of them are plain tables; pass your own with the same schema to add a site.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type

from .. import schemas

# Four sites with their entry paths.
SITES = [
    (
        "rotowire",
        "https://www.rotowire.com",
        [
            "/betting/nba/player-props",
            "/betting/nba/best-bets",
            "/betting/ncaab/best-bets",
            "/betting/nfl/best-bets",
        ],
    ),
    (
        "bettingpros",
        "https://www.bettingpros.com",
        ["/nba/picks/player-props", "/nba/odds", "/ncaab/picks/player-props", "/nfl/picks/player-props"],
    ),
    (
        "oddsshark",
        "https://www.oddsshark.com",
        ["/nba/computer-picks", "/nba/odds", "/ncaab/computer-picks", "/nfl/computer-picks"],
    ),
    (
        "covers",
        "https://www.covers.com",
        ["/nba/betting-news", "/nba/odds", "/ncaab/betting-news", "/nfl/betting-news"],
    ),
]

# Source, card, title, fallback, odds selectors, resolve links.
RULES = [
    (
        "rotowire",
        "div.betting-pick, article.pick-card, div.article-card",
        "h2, h3, .pick-title, .article-title",
        "main, div.main-content, div#content",
        {"display": ".odds, .line, .spread"},
        True,
    ),
    (
        "bettingpros",
        "tr.picks-table__row, div.prop-card, div.pick-card, div.article-card",
        ".player-name, td:first-child",
        "main, div.main-content, div#app",
        {
            "display": ".odds-value, .line-value, .prop-value",
            "over": ".over, .pick-over",
            "under": ".under, .pick-under",
        },
        False,
    ),
    (
        "oddsshark",
        "div.matchup, tr.matchup-row, div.game-card, div.odds-row",
        ".teams, .matchup-teams, .game-teams",
        "main, div.main-content, div#content",
        {
            "spread": ".spread, .line",
            "total": ".total, .over-under",
            "moneyline": ".moneyline, .ml",
            "computer_pick": ".computer-pick, .prediction",
        },
        True,
    ),
    (
        "covers",
        "article.article-card, div.article-card, div.news-card, li.article-item",
        "h2, h3, .article-title, .headline",
        "main, div.main-content, div#content",
        {},
        True,
    ),
]

# Source, path marker, category with and without it.
CATEGORY_RULES = [
    ("rotowire", "player-props", "player_props", "best_bets"),
    ("bettingpros", "player-props", "player_props", "odds_analysis"),
    ("oddsshark", "computer-picks", "predictions", "odds_analysis"),
    ("covers", "odds", "odds_analysis", "best_bets"),
]

#: Source whose cards link to articles that are read as well.
LINKED_SOURCE = "covers"
LINKED_LIMIT = 5
ARTICLE_BODY_SEL = "article, div.article-body, div.article-content"

# The four content types.
CONTENT_TYPES = ("best_bets", "player_props", "odds_analysis", "predictions")
DEFAULT_CONTENT_TYPE = "best_bets"
DEFAULT_SPORT = "NBA"

_ANSWER_FORMAT = """
Answer in this structure only:

TITLE: <headline>
META_DESCRIPTION: <summary for search results>
BODY:
<Markdown with at least two H2 headings, 500 words and one {link}>
"""

_TASKS = {
    "best_bets": "Write a round-up of the day's picks",
    "player_props": "Explain the most interesting player lines",
    "odds_analysis": "Explain how the odds moved and what that says",
    "predictions": "Present forecasts with their probabilities",
}


def default_templates(placeholder: str) -> list[tuple[str, str]]:
    """One short neutral prompt per content type; bring your own wording."""
    shown = placeholder.replace("{", "{{").replace("}", "}}")
    ending = _ANSWER_FORMAT.replace("{link}", shown)
    fields = " for {sport} on {date}.\n\nSource data:\n{source_data}\n\nKeywords: {keywords}\n"
    return [(kind, _TASKS[kind] + fields + ending) for kind in CONTENT_TYPES]


def _table(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A local relation, whose size the planner knows."""
    columns = [list(c) for c in zip(*rows)]
    arrays = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema.fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.names), schema)


def sites(spark: SparkSession) -> DataFrame:
    return _table(spark, SITES, schemas.SITES)


def rules(spark: SparkSession) -> DataFrame:
    return _table(spark, RULES, schemas.RULES)


def category_rules(spark: SparkSession) -> DataFrame:
    return _table(spark, CATEGORY_RULES, schemas.CATEGORY_RULES)


def templates(spark: SparkSession, placeholder: str) -> DataFrame:
    return _table(spark, default_templates(placeholder), schemas.TEMPLATES)
