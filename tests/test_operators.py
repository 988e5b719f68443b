"""Ranking, sinks, discovery, digest and acceptance on small tables."""

import pytest
from pyspark.sql import functions as F

from newslode.config import HARD_REJECTS, PRODUCTION, Config
from newslode.operators import acceptance, discovery, ranking, sinks, summary
from newslode.plans import engine
from newslode.sources import connectors, feeds, registry


def test_argmax_ties_keep_the_first(spark):
    df = spark.createDataFrame([("u", 3, 2, "b"), ("u", 3, 1, "a"), ("v", 1, 3, "c")], "norm_url string, score int, ord long, x string")
    assert sorted(r.x for r in ranking.dedupe_by_url(df).collect()) == ["a", "c"]


def test_merge_keeps_longest_hint_of_the_loser(spark):
    df = spark.createDataFrame([("u", "short", "", "", "m1", 9, 1), ("u", "a longer title", "s", "", "m2", 5, 2)], "url string, title_hint string, snippet_hint string, published_hint string, method string, score int, ord long")
    r = ranking.merge_candidates(df).first()
    assert (r.title_hint, r.snippet_hint, r.method, r.score) == ("a longer title", "s", "m1", 9)


def test_floor_is_the_recurrence(spark):
    import random

    g = random.Random(1)
    rows = [(f"s{i % 3}", i, g.random() < 0.3, g.randint(0, 10)) for i in range(120)]
    want = []
    for s in ("s0", "s1", "s2"):
        kept = 0
        for r in (r for r in rows if r[0] == s):
            if r[2] or (kept < 6 and r[3] >= 6):
                kept += 1
                want.append(r[1])
    df = spark.createDataFrame(rows, "source_name string, candidate_rank int, accepted boolean, score int")
    assert sorted(r.candidate_rank for r in ranking.prefilter_floor(df).collect()) == sorted(want)


def test_sink_rows(spark):
    rows = spark.createDataFrame([("k1", 1), ("k1", 2), ("k2", 3), ("k3", 4)], "UniqueKey string, ord long")
    have = spark.createDataFrame([("k2",), ("k2",)], "UniqueKey string")
    new, again = sinks.new_rows(rows, have), sinks.duplicate_rows(rows, have)
    assert sorted(r.ord for r in new.collect()) == [1, 4] and sorted(r.ord for r in again.collect()) == [2, 3]
    assert tuple(sinks.counters(new, again).first()) == (2, 2, 4)
    none = rows.limit(0)
    assert sinks.alert_rows(none, again, rows, "created_or_duplicates").count() == 2 and sinks.alert_rows(none, again, rows, "created_only").count() == 0 and sinks.alert_rows(new, again, rows, "all_generated").count() == 4


def test_digest(spark):
    cols = "Metal string, SourceName string, SourceUrl string, Theme string, Stance string, Synopsis string, KeyPoints string, WatchItems string, RiskFlags string, ord long"
    df = spark.createDataFrame([("Copper", "S", "u", "Supply outlook", "Bullish", "Inventories at the warehouse fell again", "- Prices rally on the exchange\n- tiny", "", "", 1), ("copper", "S", "v", "Supply outlook", "Bullish", "inventories at the warehouse FELL again", "", "", "", 2), ("All", "S", "w", "", "", "", "", "", "", 3)], cols)
    got = summary.digest_groups(df)
    by = {(r.label, r.section): [] for r in got.collect()}
    for r in got.orderBy("place").collect():
        by[r.label, r.section].append(r.text)
    assert by["Copper", "inventory"] == ["Inventories at the warehouse fell again"]
    assert by["Copper", "price"] == ["Prices rally on the exchange"] and len(by["Copper", "drivers"]) == 2  # lent
    assert {k[0] for k in by} == {"Copper"}
    page = summary.digest_html(got, "x").first().html
    assert page.index("<h2>Copper</h2>") < page.index("Price") and "Analyst tone" in page
    assert summary.subject(1, "All", "d") == "Analyst Brief Alert | 1 new item | All Markets | d"


def test_traversal_and_joins(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "c"), ("c", "a")], "src string, dst string")
    got = {r.url: r.depth for r in discovery.reachable(edges, spark.createDataFrame([("a",)], "url string")).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 2}
    src = registry.fixture(spark)
    asked = spark.createDataFrame([("NEWS ",)], "name string")
    assert [r.source_name for r in discovery.selected_sources(src, asked).collect()] == ["news"]
    assert discovery.selected_sources(src, asked.limit(0)).count() == 3
    names = spark.createDataFrame([("news",), ("data",)], "name string")
    assert [r.source_name for r in discovery.fallback_sources(src, src.where("source_name = 'news'"), names).collect()] == ["data"]
    assert registry.check_names(src, ["news", "nobody"]) == ["nobody"]


def test_unwrap_and_providers(spark):
    u = discovery.unwrap_result
    r = spark.range(1).select(u(F.lit("https://g.com/url?q=https%3A%2F%2Fa.b%2Fc&x=1")), u(F.lit("https://d.com/l/?uddg=https%3A%2F%2Fa.b")), u(F.lit("https://a.b/?q=1")), discovery.provider_alias(F.lit("DDG"))).first()
    assert tuple(r) == ("https://a.b/c", "https://a.b", "https://a.b/?q=1", "duckduckgo")


def test_feeds(spark):
    rss = '<?xml version="1.0"?><rss><channel><item><title>Copper up</title><link>https://a.b/x?y=1</link><description>d</description><pubDate>Tue, 7 Apr 2026 10:00:00 +0000</pubDate></item><item><title>Copper market update</title><link>https://a.b/x</link></item></channel></rss>'
    got = feeds.rss_candidates(spark.createDataFrame([("f", rss)], "feed_url string, xml string"), Config(lexicon=PRODUCTION)).collect()
    assert [(r.url, r.method) for r in got] == [("https://a.b/x", "rss")]
    maps = spark.createDataFrame([("m0", "<sitemapindex><sitemap><loc>m1</loc></sitemap></sitemapindex>"), ("m1", '<urlset xmlns="x"><url><loc>https://a.b/1</loc><lastmod>2026-04-07</lastmod></url></urlset>')], "map_url string, xml string")
    got = feeds.sitemap_urls(maps, spark.createDataFrame([("m0",)], "map_url string")).collect()
    assert [(r.url, r.lastmod) for r in got] == [("https://a.b/1", "2026-04-07")]


def test_connectors(spark):
    payload = F.lit('{"link": "https://a.b", "metadata": {"title": "T"}}')
    r = spark.range(1).select(connectors.normalize_external(payload).alias("c")).first().c
    assert (r.url, r.title_hint, r.snippet_hint) == ("https://a.b", "T", "")
    assert connectors.backend_order("auto") == ["hosted", "local", "rule"] and connectors.backend_order("auto", True)[0] == "local"
    urls = spark.createDataFrame([("https://a.b/x",), ("https://a.b/private/y",), ("https://c.d/private",)], "url string")
    rules = spark.createDataFrame([("a.b", "/private"), ("a.b", "")], "host string, disallow string")
    assert sorted(r.url for r in connectors.robots_allow(urls, rules).collect()) == ["https://a.b/x", "https://c.d/private"]


BODY = "Copper market analysis and outlook for the week ahead as smelter supply tightens and stocks fall. " * 3


def article(spark, body=BODY, hint="today", role="narrative_news", title="Copper market update"):
    page = f"<html><head><title>{title}</title></head><body><article>" + "".join(f"<p>{body}</p>" for _ in range(5)) + "</article></body></html>"
    pages = spark.createDataFrame([("https://example.com/2026/04/07/copper-story", page, title, hint, "")], "url string, html string, title_hint string, published_hint string, snippet_hint string")
    src = registry.fixture(spark).where("source_name = 'news'").withColumn("source_role", F.lit(role))
    return engine.judge(pages, src, Config(lexicon=PRODUCTION)).first()


def test_accepts_a_full_article(spark):
    r = article(spark)
    assert r.acceptance.accepted, (r.acceptance, r.verification)
    # page_verified 5, primary 2, body 2, context 3, date 3, scope 1; the page reads as a report, so no narrative fit
    assert r.acceptance.score == 16 and r.relevance.should_summarize and r.verification.confidence == "high"


@pytest.mark.parametrize("change,code", [({"body": "Nothing to see here but plain words of no use at all. " * 9, "title": "x"}, "missing_market_context_after_page_check"), ({"body": "Copper."}, "insufficient_narrative_body")])
def test_hard_rejects(spark, change, code):
    r = article(spark, **change)
    assert not r.acceptance.accepted and code in r.acceptance.reject_reasons and code in HARD_REJECTS


def story_pages(spark, paths, body=BODY):
    page = "<html><head><title>Copper market update</title></head><body><article>" + "".join(f"<p>{body}</p>" for _ in range(5)) + "</article></body></html>"
    return spark.createDataFrame([(f"https://example.com/2026/04/07/{p}", page, "Copper market update", "today", "") for p in paths], "url string, html string, title_hint string, published_hint string, snippet_hint string")


def test_variants_of_one_url_take_one_place(spark):
    """More variants of one page than the cap of its source."""
    cfg = Config(lexicon=PRODUCTION)
    most = cfg.per_source_limit * cfg.headroom
    pages = story_pages(spark, [*(f"a-story?x={i:02}" for i in range(most + 4)), "b-story"])
    src = registry.fixture(spark).where("source_name = 'news'").withColumn("source_role", F.lit("narrative_news"))
    got = engine.articles(pages, src, cfg)
    assert sorted(r.source_url.split("/")[-1] for r in got.collect()) == ["a-story?x=00", "b-story"]


def test_page_quality(spark):
    q = acceptance.page_quality(F.lit(200), F.lit("x" * 5000), F.lit("y" * 700), F.lit("t"), "article", 120)
    b = acceptance.page_quality(F.lit(403), F.lit("captcha"), F.lit(""), F.lit(""), "article", 120)
    assert tuple(spark.range(1).select(q, b).first()) == (4 + 3 + 4 + 1 + 2, 1 - 6)
