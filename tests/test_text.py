import html

import pytest
import yaml

from newsloom.functions import html as H
from newsloom.functions import text as X
from newsloom.functions import urls as U
from newsloom.functions.response import UNREADABLE, flat_meta, frontmatter_block, frontmatter_body, parse_response, read_meta


#: Title, slug and file name, written out.
NAMES = [
    ("Top 5 Picks: Lakers & Celtics!", "top-5-picks-lakers-celtics", "best_bets_top-5-picks-lakers-celtics.md"),
    ("  A_b  the Rémix—étre ", "a-b-the-rémixétre", "best_bets_a_b-the-rémixétre.md"),
    ("???", "", "best_bets_.md"),
    ("", "", "best_bets_.md"),
    ("x" * 59 + " y z", "x" * 59, "best_bets_" + "x" * 59 + "-.md"),
    ("x" * 80, "x" * 60, "best_bets_" + "x" * 60 + ".md"),
    ("ÉCOLE du soir", "école-du-soir", "best_bets_école-du-soir.md"),
    ("one\ttwo\x0bthree", "one-two-three", "best_bets_one-two-three.md"),
    ("-- both ends --", "both-ends", "best_bets_---both-ends---.md"),
    ("日本語 タイトル 2", "日本語-タイトル-2", "best_bets_日本語-タイトル-2.md"),
]


def test_slug_and_file_name(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in NAMES], "t string")
    got = df.select("t", X.slugify("t").alias("s"), X.safe_filename(X.F.lit("best_bets"), "t").alias("f")).collect()
    assert [tuple(r) for r in got] == NAMES


@pytest.mark.parametrize("text", ["best_bets_foo bar", "o'neil's 3rd-place", "ÉTÉ à paris", "ALL caps"])
def test_title_case(one, text):
    assert one(X.title_case, text) == text.title()


@pytest.mark.parametrize("text", ["", "a b  c\n\nd", " x y\x1cz ", "word " * 500])
def test_word_count(one, text):
    assert one(X.word_count, text) == len(text.split())


def test_escape_and_json_list(one):
    assert one(X.xml_escape, "A & B <C> &amp;") == "A &amp; B &lt;C&gt; &amp;amp;"
    assert one(lambda: X.json_string_list(X.F.array(X.F.lit('a"b'), X.F.lit("c")))) == '["a\\"b", "c"]'


@pytest.mark.parametrize(
    "path,sport",
    [("/betting/nba/x", "NBA"), ("/ncaab/odds", "NCAAB"), ("/nfl", "NFL"), ("/wnba/", "NBA"), ("/NHL/", "NHL"), ("/random", "UNKNOWN")],
)
def test_sport(one, path, sport):
    assert one(U.sport_from_path, path) == sport


@pytest.mark.parametrize(
    "href,want",
    [
        ("/a", "https://site.example/a"), ("//cdn/a", "https://site.example//cdn/a"), ("http://a", "http://a"),
        ("a.html", "https://site.example/p"), ("", "https://site.example/p"),
    ],
)
def test_links(one, href, want):
    assert one(U.resolve_link, href, "https://site.example", "https://site.example/p") == want


RESPONSE = 'TITLE: "Five Picks"\nMETA_DESCRIPTION: Short text. \nBODY:\n# Five\n\n## One\ntext\n'


@pytest.mark.parametrize(
    "text,want",
    [
        (RESPONSE, ("Five Picks", "Short text.", "# Five\n\n## One\ntext")),
        ("", ("", "", "")),
        ("TITLE: T\nBODY:\nx", ("T", "", "x")),
        ("TITLE:\nnext line\nBODY: same line", ("next line", "", "")),
        ("TITLE: T\r\nBODY:\r\nx\r\n", ("T", "", "x")),
        ("say TITLE: no", ("", "", "")),
        ("BODY:  \n\n\nlate\u0085end", ("", "", "late\u0085end")),
    ],
)
def test_parse_response(one, text, want):
    assert tuple(one(parse_response, text)) == want


def test_frontmatter_parts(one):
    text = '---\ntitle: "Best Day"\nslug: best-day\nslug: best-day-2\ncategory: NBA\n---\n## Top\n\nText\n---\n'
    assert one(frontmatter_body, text) == "## Top\n\nText\n---\n"
    assert one(lambda t: flat_meta(frontmatter_block(t)), text) == {
        "title": "Best Day", "slug": "best-day-2", "category": "NBA",
    }
    assert one(frontmatter_body, "Just text.\n") == "Just text.\n"
    assert one(lambda t: flat_meta(frontmatter_block(t)), "Just text.\n") == {}


@pytest.mark.parametrize(
    "block,meta,lists",
    [
        ("title: 'It''s'\ntags:\n  - NBA\n  - \"a \\\"b\\\\\"\n# c\nslug: s-1 # end", {"title": "It's", "slug": "s-1"}, {"tags": ["NBA", 'a "b\\']}),
        ("k: [x, \"y, z\", 'q']\ne:\na: 1\na: 2", {"a": "2"}, {"k": ["x", "y, z", "q"]}),
        ("tags: old\ntags:\n- new\n\n-  other \r\ndate: 2026-02-17", {"date": "2026-02-17"}, {"tags": ["new", "other"]}),
        ('a: ~\nb: "x\\ny"\nkey two: v:w', {"a": None, "b": "x\ny", "key two": "v:w"}, {}),
        ("", {}, {}),
    ],
)
def test_front_matter_lines(one, block, meta, lists):
    got = one(read_meta, block)
    assert (got["meta"], got["lists"], got["error"]) == (meta, lists, None)
    parsed = yaml.safe_load(block) or {}
    assert {k: v for k, v in parsed.items() if isinstance(v, list)} == lists
    assert {k: None if v is None else str(v) for k, v in parsed.items() if not isinstance(v, list) and k != "e"} == meta


@pytest.mark.parametrize("block", ["- a", "a:\n  b: 1", "a: |\n  x", "a: b: c", "t: 'open", "a: {b: 1}", "a: 1\n- b", "just text"])
def test_front_matter_that_is_rejected(one, block):
    assert one(read_meta, block)["error"] == UNREADABLE


def test_html_fields(one):
    page = "<html><head><title> A &amp; B </title><script>var x='<p>';</script></head><article><p>One <b>two<br>three<!-- no --></article>"
    assert one(H.page_title, page) == "A & B"
    assert one(lambda h: H.visible_text(H.body_fragment(h)), page) == "One\ntwo\nthree"


ENTITIES = [
    "It&#8217;s caf&eacute; &amp; bar", "&#x2019;&#X41;&#128;&#0;&#55296;&#9999999;", "&amp;lt; &nbsp;&hellip;&copy 2024",
    "a & b &; &unheard; &#; &#x;", "no signs", "&lt;p&gt;", "&quot;x&#39;", "&AMP; &amp", "&",
]


@pytest.mark.parametrize("text", ENTITIES)
def test_entities(one, text):
    assert one(H.unescape, text) == html.unescape(text)


@pytest.mark.parametrize(
    "page,body",
    [
        ("<article>a</article>tail", "a"),
        ("x<article class='m'>a<article>b</article>c</ARTICLE >tail</article>", "a<article>b</article>c"),
        ("<article>a<article>b</article><article>c</article>d</article>e", "a<article>b</article><article>c</article>d"),
        ("<article>open", "open"),
        ("none", ""),
    ],
)
def test_nested_articles(one, page, body):
    assert one(H.body_fragment, page) == body
