import pytest
from pyspark.sql import functions as F

from newsloom.plans import flow, queries
from newsloom.plans.flow import run_stages
from newsloom.plans.settings import Settings
from newsloom.sources.published import read_manifest
from newsloom.sources.raw import write_raw
from newsloom.streaming.incremental import run_incremental

DAY = "2026-02-01"
CARD = '<div class="betting-pick"><h3>{}</h3><p>{}</p></div>'


def answers(df):
    text = F.concat(F.lit("TITLE: "), "title", F.lit("\nMETA_DESCRIPTION: m\nBODY:\n## A\n\n"), "content")
    return df.select("article_id", text.alias("response"))


def test_stages(spark, tmp_path):
    base = str(tmp_path)
    html = "".join(CARD.format(t, c) for t, c in (("Hawks win tonight", "a"), ("Hawks win tonight!", "b"), ("", "c"), ("Suns to cover", "d")))
    news = '<article class="article-card"><h2>Big story</h2><a href="/story">x</a></article>'
    rows = [
        (1, "https://www.rotowire.com/betting/nba/best-bets", html), (2, "https://www.covers.com/nba/odds", news),
        (3, "https://www.covers.com/story", "<article>The whole story</article>"), (4, "https://elsewhere.example/", html),
    ]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(base + "/pages")
    out = run_stages(spark, base, DAY, ("extract", "prompt"), wanted_sites=("rotowire", "covers", "nowhere"))
    assert {r.source: r.records for r in out["raw"].collect()} == {"rotowire": 4, "covers": 1}
    assert [r.source for r in out["unknown_sites"].collect()] == ["nowhere"] and out["missing_sites"].count() == 0
    asked = out["prompts"].orderBy("ord").collect()
    assert [r.title for r in asked] == ["Big story", "Hawks win tonight"]
    assert asked[0].content == "The whole story" and asked[0].url == "https://www.covers.com/story"
    assert "best_bets" in asked[1].prompt and "raw_html" not in asked[1].prompt

    answers(out["prompts"]).write.parquet(base + "/responses")
    out = run_stages(spark, base, DAY, ("rewrite", "publish"))
    assert tuple(out["seo"].first()) == (0, 2)
    assert sorted(r.slug for r in out["published"].collect()) == ["best_bets_hawks-win-tonight", "odds_analysis_big-story"]
    again = run_stages(spark, base, DAY, ("publish",), batch_id="again")
    assert again["published"].count() == 0
    run_stages(spark, base, DAY, ("publish",))
    manifest = read_manifest(spark, base + "/manifest")
    assert manifest.count() == 2 and manifest.select("slug").distinct().count() == 2


def test_rejects_do_not_stop_a_run(spark, tmp_path):
    base = str(tmp_path)
    html = CARD.format("One good title", "a") + CARD.format("Completely different", "b")
    spark.createDataFrame([(1, "https://www.rotowire.com/nba", html)], "page_id long, url string, html string").write.parquet(base + "/pages")
    out = run_stages(spark, base, DAY, ("extract", "prompt"), settings=Settings(deduplicate=False))
    good = answers(out["prompts"].where("title like 'One%'"))
    bad = out["prompts"].where("title not like 'One%'").select("article_id", F.lit("no sections").alias("response"))
    good.union(bad).write.parquet(base + "/responses")
    out = run_stages(spark, base, DAY, ("rewrite", "publish"))
    assert out["published"].count() == 1
    rejects = spark.read.parquet(base + "/rejects")
    assert [r.error for r in rejects.collect()] == ["response without a title"]


def test_incremental(spark, tmp_path):
    base = str(tmp_path / "out")
    settings = Settings(threshold=1.0)

    def drop(name, *titles):
        rows = [(i, t, f"https://x.example/{t}", "text of " + t, "best_bets", "NBA", name, DAY) for i, t in enumerate(titles)]
        df = spark.createDataFrame(rows, "ord long, title string, url string, content string, category string, sport string, source string, date string")
        write_raw(df, str(tmp_path / "in" / name), "t", "envelope")

    def answer(asked):
        stored = spark.read.parquet(base + "/articles_in").select("article_id", "title", "content")
        return answers(asked.join(stored, "article_id"))

    def run():
        run_incremental(spark, str(tmp_path / "in"), base, str(tmp_path / "checkpoint"), DAY, answer, settings)
        return sorted((r.slug, r.batch_id[-1]) for r in read_manifest(spark, base + "/manifest").collect())

    drop("s1", "Alpha", "Beta", "Beta")
    first = run()
    assert first == [("best_bets_alpha", "0"), ("best_bets_beta", "0")]
    assert run() == first
    drop("s2", "Beta", "Gamma")
    assert run() == [*first, ("best_bets_gamma", "1")]


def test_staged_run_is_registered_with_title_similarity(spark, monkeypatch):
    asked = []

    def stop(*args, settings, **kwargs):
        asked.append(settings)
        raise InterruptedError

    monkeypatch.setattr(queries.flow, "run_stages", stop)
    with pytest.raises(InterruptedError):
        queries.q_staged_run(spark, "/root/testdata/sf0.001")
    assert asked == [Settings()]


def test_articles_of_one_file_are_read_by_many_tasks(spark, tmp_path):
    base = str(tmp_path)
    text = F.concat(F.lit("---\nslug: a-"), F.col("id").cast("string"), F.lit("\n---\nbody"))
    rows = spark.range(2000).select(F.lit(DAY).alias("date"), F.col("id").cast("string").alias("stem"), text.alias("text"))
    rows.coalesce(1).write.parquet(f"{base}/texts")
    read = flow.read_articles(spark.read.parquet(f"{base}/texts"), DAY, Settings())
    used = read.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(used) == 8 and max(r["count"] for r in used) < 500
    assert sorted(r.slug for r in read.collect()) == sorted(f"a-{i}" for i in range(2000))
    # few rows stay where they are
    few = flow.read_articles(spark.read.parquet(f"{base}/texts").where("stem = '7'"), DAY, Settings())
    assert [r.slug for r in few.collect()] == ["a-7"]
