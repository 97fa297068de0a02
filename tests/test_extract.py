import pytest

from newsloom.functions.selectors import Page, parse_selector
from newsloom.operators.enrich import enrich_linked
from newsloom.operators.extract import extract_body, extract_cards, extract_records
from newsloom.sources import catalog

PICKS = """<html><head><title>Evening picks</title></head><body><main>
  <div class="betting-pick"><h3 class="pick-title">Hawks <b>+2</b> at Bulls</h3><span class="odds">-115</span>
    <p>Hawks won six of eight.</p><a href="/betting/nba/hawks-bulls">More</a></div>
  <div class="other betting-pick"><h3>Suns win</h3><span class='line'>+140</span><script>var a = "<p>x</p>";</script><p>At home &amp; rested</p></div>
</main></body></html>"""
NEWS = """<main><article class="article-card"><h2 class="headline">One</h2><p>First</p><a href="/nba/one">Read</a></article>
<div class="news-card"><div class="article-card"><span class="headline">Inner</span></div><a>no link</a></div>
<ul><li class="article-item">Two<li class="article-item">Three <a href="x.html">t</a></ul></main>"""
TABLE = """<table><tr class="picks-table__row"><td>Jo Ann<td class="odds-value">-110</td><td class="over">o7.5<tr class="picks-table__row">
<td><span class="x">Al</span></td><td class="pick-under">u3</td></tr></table>"""
MATCH = """<div class="matchup"><div class="teams">A <i>@</i> B</div><span class="total">210</span><span class="ml">+105</span>
<span class="prediction">B</span><a href="https://else.example/x">x</a></div>"""


def pages(spark, *rows):
    return spark.createDataFrame(
        [(i, s, f"https://www.{s}.com{p}", h) for i, (s, p, h) in enumerate(rows)],
        "page_id long, source string, url string, html string",
    )


def records(spark, *rows):
    out = extract_records(pages(spark, *rows), catalog.rules(spark), catalog.sites(spark), catalog.category_rules(spark))
    return out.orderBy("page_id", "pos").collect()


def test_pick_cards(spark):
    a, b = records(spark, ("rotowire", "/betting/nba/best-bets", PICKS))
    assert (a.title, b.title) == ("Hawks+2at Bulls", "Suns win")
    assert (a.odds_data, b.odds_data) == ({"display": "-115"}, {"display": "+140"})
    assert a.url == "https://www.rotowire.com/betting/nba/hawks-bulls"
    assert b.url == "https://www.rotowire.com/betting/nba/best-bets"
    assert b.content == "Suns win\n+140\nAt home & rested"
    assert a.raw_html.startswith('<div class="betting-pick">') and a.raw_html.endswith("</a></div>")
    assert a.raw_html in PICKS
    assert (a.sport, a.category, a.needs_full_scrape, b.needs_full_scrape) == ("NBA", "best_bets", True, False)


def test_news_cards_nested_and_unclosed(spark):
    rows = records(spark, ("covers", "/ncaab/odds", NEWS))
    assert [r.title for r in rows] == ["One", "Inner", "Inner", "", ""]
    assert [r.content for r in rows][3:] == ["Two", "Three\nt"]
    assert [r.needs_full_scrape for r in rows] == [True, False, False, False, True]
    assert rows[4].url == "https://www.covers.com/ncaab/odds"
    assert {r.category for r in rows} == {"odds_analysis"} and {r.sport for r in rows} == {"NCAAB"}


def test_table_rows_and_matchups(spark):
    a, b, c = records(spark, ("bettingpros", "/nfl/picks/player-props", TABLE), ("oddsshark", "/nhl/computer-picks", MATCH))
    assert (a.title, a.odds_data) == ("Jo Ann", {"display": "-110", "over": "o7.5"})
    assert (b.title, b.odds_data) == ("Al", {"under": "u3"})
    assert (a.category, a.needs_full_scrape) == ("player_props", False)
    assert c.odds_data == {"total": "210", "moneyline": "+105", "computer_pick": "B"}
    assert (c.title, c.url, c.category) == ("A@B", "https://else.example/x", "predictions")


def test_fallback_and_nothing(spark):
    rows = records(
        spark,
        ("rotowire", "/x", "<html><head><title> T </title></head><main><p>Some <b>text</b></main>after"),
        ("bettingpros", "/x", "<div id=app>app</div>"),
        ("covers", "/x", "<div id=app>app</div>"),
        ("oddsshark", "/x", '<p class="main-content">not a div</p>'),
        ("covers", "/x", ""),
    )
    assert [(r.page_id, r.title, r.content, r.odds_data) for r in rows] == [(0, "T", "Some\ntext", {}), (1, "", "app", {})]


def test_encoded_class_is_not_missed(spark):
    html = '<div class="betting&#45;pick"><h2>E</h2></div>'
    assert [r.title for r in records(spark, ("rotowire", "/x", html))] == ["E"]


def test_body(spark):
    df = spark.createDataFrame(
        [(1, "u1", "<p>x</p><div class='article-body'>Body <i>here</i></div>"), (2, "u2", "<article>A</article>"), (3, "u3", "<p>none</p>"), (4, "u4", None)],
        "page_id long, url string, html string",
    )
    got = {r.page_id: (r.content, r.raw_html) for r in extract_body(df).collect()}
    assert got == {1: ("Body\nhere", "<div class='article-body'>Body <i>here</i></div>"), 2: ("A", "<article>A</article>")}


def test_enrichment_takes_all_or_the_first_ones(spark):
    articles = spark.createDataFrame(
        [(i, "s", "d", f"u{i}", f"c{i}", "", i != 2) for i in range(9)],
        "ord long, source string, date string, url string, content string, raw_html string, needs_full_scrape boolean",
    )
    bodies = spark.createDataFrame([(f"u{i}", f"full{i}", "r") for i in range(9) if i != 1], "url string, content string, raw_html string")
    got = [r.content for r in enrich_linked(articles, bodies).orderBy("ord").collect()]
    assert got == ["full0", "c1", "c2", *[f"full{i}" for i in range(3, 9)]]
    got = [r.content for r in enrich_linked(articles, bodies, limit=5).orderBy("ord").collect()]
    assert got == ["full0", "c1", "c2", "full3", "full4", "full5", "c6", "c7", "c8"]


def test_rank_is_limited_before_the_shuffle(spark):
    articles = spark.createDataFrame(
        [(i, "s", "d", "u", "c", "", True) for i in range(10)],
        "ord long, source string, date string, url string, content string, raw_html string, needs_full_scrape boolean",
    )
    plan = enrich_linked(articles, articles.select("url", "content", "raw_html").distinct(), limit=5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_selector_forms():
    assert len(parse_selector("h2, .a, div.b, div#c, a[href], td:first-child")) == 6
    with pytest.raises(ValueError):
        parse_selector("div > p")
    page = Page("<p>a < b <!-- c -->d</p><br/><img src=x>e")
    assert page.pieces == ["a < b", "d", "e"]


def test_cards_leave_a_batch_slice_by_slice(spark, monkeypatch):
    """However many pages a batch has, only some of them are objects at once."""
    import pyarrow as pa

    from newsloom.operators import extract

    html = ["<li>a</li>", None, "<p>" * 400, "", "<li>b</li>"]
    taken = []
    read = lambda h: taken.append(h) or []
    parts = extract._in_slices(iter([(pa.array(html),), (pa.array([], pa.string()),)]), read, extract.T.ArrayType(extract.CARD), 100)
    assert (len(next(parts)), len(taken)) == (2, 2)
    assert [len(p) for p in parts] == [1, 2, 0] and taken == html
    some = [("rotowire", "/nba/odds", PICKS), ("covers", "/ncaab/odds", NEWS), ("rotowire", "/nba/odds", "")] * 5
    whole = records(spark, *some)
    monkeypatch.setattr(extract, "SLICE_BYTES", 1)
    assert records(spark, *some) == whole and len(whole) == 35
