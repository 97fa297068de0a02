from urllib.robotparser import RobotFileParser

from newsloom import schemas
from newsloom.operators.frontier import robots_allowed, seed_urls, select_sites
from newsloom.sources import catalog
from newsloom.sources.pages import pages_of_sites

AGENT = "LoomBot/1.0 (+https://example.com)"
FILES = {
    "a.example": "User-agent: *\nDisallow: /admin/\nAllow: /admin/open",
    "b.example": "User-agent: *\nAllow: /admin/open\nDisallow: /admin/",
    "c.example": "User-agent: *\nDisallow: /\n\nUser-agent: loom\nDisallow: /private\nDisallow:",
    "d.example": "User-agent: other\nDisallow: /\n",
    "e.example": "User-agent: *\nDisallow: /x?\nDisallow: /q?a=1\nDisallow: /caf%C3%A9\nDisallow: *",
    "f.example": "User-agent: bot\nUser-agent: zzz\nDisallow: /one\n\nUser-agent: loombot\nDisallow: /two",
}
PATHS = ["", "/", "/admin/", "/admin/open", "/admin", "/private/1", "/x", "/x?y=1", "/q?a=12", "/q?b=1", "/caf%C3%A9/1", "/café", "/one", "/two", "/a+b%zz", "/*"]


def rules_of(host, text):
    """Rows of a robots file; good enough for the files above."""
    rows, entry, agents, in_rules, pos = [], 1, [], False, 0
    for line in text.split("\n"):
        key, _, value = line.partition(":")
        value = value.strip()
        if key.lower() == "user-agent":
            if in_rules:
                entry, agents, in_rules = entry + 1, [], False
            agents.append(value)
        elif value or key:
            in_rules, pos = True, pos + 1
            rows += [(host, entry, pos, a, key.lower() == "allow", value) for a in agents] if key else []
    return rows


def test_robots_as_in_the_standard_library(spark):
    rules = [r for h, t in FILES.items() for r in rules_of(h, t)]
    urls = [f"https://{h}{p}" for h in [*FILES, "none.example"] for p in PATHS]
    got = {
        r.url: r.allowed
        for r in robots_allowed(
            spark.createDataFrame([(u,) for u in urls], "url string"), spark.createDataFrame(rules, schemas.ROBOTS), AGENT
        ).collect()
    }
    for host, text in {**FILES, "none.example": ""}.items():
        parser = RobotFileParser()
        parser.parse(text.splitlines())
        for p in PATHS:
            url = f"https://{host}{p}"
            assert got[url] == parser.can_fetch(AGENT, url), url


def test_bad_url_is_allowed(spark):
    urls = spark.createDataFrame([("no url",), (None,)], "url string")
    rows = robots_allowed(urls, spark.createDataFrame([], schemas.ROBOTS), AGENT).collect()
    assert [r.allowed for r in rows] == [True, True]


def test_seeds_and_selection(spark):
    sites = catalog.sites(spark)
    seeds = seed_urls(sites)
    assert seeds.count() == 16
    assert seeds.where("source = 'covers' and pos = 1").first().url == "https://www.covers.com/nba/odds"
    chosen, unknown = select_sites(sites, spark.createDataFrame([("covers",), ("nowhere",)], "source string"))
    assert [r.source for r in chosen.collect()] == ["covers"]
    assert [r.source for r in unknown.collect()] == ["nowhere"]


def test_pages_of_sites(spark):
    pages = spark.createDataFrame([(1, "https://www.covers.com/nba/odds?x=1", ""), (2, "http://elsewhere.example/", ""), (3, ":::", "")], "page_id long, url string, html string")
    rows = pages_of_sites(pages, catalog.sites(spark)).collect()
    assert [(r.page_id, r.source, r.path) for r in rows] == [(1, "covers", "/nba/odds?x=1")]
