"""The composed run on hand-made pages: what is found, filtered, judged, capped and published."""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newslode.config import PRODUCTION, Config
from newslode.functions import html
from newslode.operators import acceptance, discovery, ranking
from newslode.plans import engine
from newslode.sources import feeds, registry

CFG = Config(lexicon=PRODUCTION, max_candidates=40, per_source_limit=2)
BODY = "Copper market analysis and outlook for the week ahead as smelter supply tightens and stocks fall. " * 3
DAY = "https://example.com/2026/04/07/"


def page(title, body=BODY):
    return f"<html><head><title>{title}</title></head><body><article>" + "".join(f"<p>{body}</p>" for _ in range(5)) + "</article></body></html>"


PAGES = [
    (f"{DAY}copper-a?ref=1", page("Copper a")), (f"{DAY}copper-a", page("Copper a, the longer copy")), (f"{DAY}copper-b", page("Copper b")),
    (f"{DAY}bread", page("Bread", "A recipe of bread with flour and water and nothing else at all. " * 6)),
    ("https://example.com/2019/04/07/copper-old", page("Copper of old")), ("https://example.org/2026/04/07/copper-c", page("Copper c")),
]


def candidates(spark, urls, method="listing"):
    rows = [(u, "https://example.com/news", u.rsplit("/", 1)[1].replace("-", " ") + " market", "", "today", method, 6, n) for n, u in enumerate(urls)]
    return spark.createDataFrame(rows, "url string, listing_url string, title_hint string, snippet_hint string, published_hint string, method string, score int, ord long")


@pytest.fixture(scope="module")
def parts(spark):
    pages = spark.createDataFrame(PAGES, "url string, html string")
    sources = registry.fixture(spark).where("source_name <> 'data'").withColumn("source_role", F.lit("narrative_news"))
    return pages, sources


def test_run_from_discovery(spark, parts):
    pages, sources = parts
    news = sources.where("source_name = 'news'")
    stages = {"rss": candidates(spark, [f"{DAY}copper-a", "https://example.com/2019/04/07/copper-old", "https://nobody.test/2026/04/07/copper-x"], "rss"), "traversal": candidates(spark, [f"{DAY}copper-a", f"{DAY}copper-b", f"{DAY}bread", f"{DAY}copper-lost"])}
    wanted = {r.url.rsplit("/", 1)[1]: r for r in engine.candidates(stages, news, CFG).collect()}
    # An old page, and hosts of no source, aren't candidates; of one url the best remains.
    assert {"copper-a", "copper-b", "copper-lost"} <= set(wanted) and not {"copper-old", "copper-x"} & set(wanted) and wanted["copper-a"].method == "rss"
    existing = spark.createDataFrame([], "UniqueKey string")
    created = engine.run(pages, news, existing, CFG, "r1", stages=stages).created.collect()
    # The longer copy of a page is read.
    assert sorted((r.SourceUrl, r.SourceName, r.Title, r.RunId) for r in created) == [(f"{DAY}copper-a", "news", "Copper a, the longer copy", "r1"), (f"{DAY}copper-b", "news", "Copper b", "r1")]


def test_fallback_sources(spark, parts):
    pages, sources = parts
    cfg = Config(lexicon=PRODUCTION)
    nothing = pages.where("url like '%.org/%'")
    names = spark.createDataFrame([("research",), ("nobody",)], "name string")
    got = engine.run(nothing, sources, spark.createDataFrame([], "UniqueKey string"), cfg, "r", selected=sources.where("source_name = 'news'"), fallback=names)
    assert [(r.source_name, r.source_url) for r in got.articles.collect()] == [("research", "https://example.org/2026/04/07/copper-c")]


def test_html_before_pdf_and_caps(spark):
    rows = [("a", "h1", False, True, 2), ("a", "h2", False, True, 3), ("a", "p1", True, True, 1), ("b", "h1", False, True, 2), ("b", "h2", False, False, 3), ("b", "p1", True, True, 1)]
    df = spark.createDataFrame(rows, "source_name string, url string, is_pdf boolean, accepted boolean, candidate_rank int")
    want = [("a", "h1"), ("a", "h2"), ("b", "h1"), ("b", "h2"), ("b", "p1")]
    for bounded in (False, True):
        assert sorted((r.source_name, r.url) for r in ranking.html_first(df, 6, bounded).collect()) == want
    assert sorted((r.source_name, r.url) for r in ranking.capped_accepted(df, 1, 2).collect()) == [("a", "h1"), ("b", "h1")]
    assert sorted((r.source_name, r.url) for r in ranking.capped_accepted(df, 3, 3).collect()) == [("a", "h1"), ("a", "h2"), ("a", "p1"), ("b", "h1"), ("b", "p1")]


def test_floor_equals_the_walk(spark):
    """Against the walk in plain Python: a reject is kept while fewer than the floor are."""
    import random

    random.seed(4)
    rows = [(f"s{random.randrange(4)}", i, random.randrange(12), random.random() < 0.2) for i in range(400)]
    want = []
    for s in sorted({r[0] for r in rows}):
        kept = 0
        for r in [r for r in rows if r[0] == s]:
            if r[3] or (r[2] >= 6 and kept < 5):
                kept += 1
                want.append(r[1])
    df = spark.createDataFrame(rows, "source_name string, candidate_rank int, score int, accepted boolean")
    assert sorted(r.candidate_rank for r in ranking.prefilter_floor(df, 5, 6).collect()) == sorted(want)


def test_paragraphs_nest_and_tables_count(spark):
    long = "word " * 10
    page = f"<ul><li><p>{long}</p></li></ul><p>{long}<p>{long}</p><p>{'12.5 % ' * 9}</p><table><tr><td>one two</td></tr></table>"
    m = spark.createDataFrame([(page,)], "h string").select(html.narrative_metrics("h").alias("m")).first().m
    n = len(long.strip())
    assert (m.narrative_chars, m.narrative_paragraphs) == (4 * n, 4)
    seen = 3 * n + len(("12.5 % " * 9).strip()) + len("one two") + 4
    assert m.table_density == round(len("one two one two one two") / seen, 3)


def test_cards_go_by_container(spark):
    page = '<div>Same text<a href="/a">one</a></div><div>Same text<a href="/b">one</a></div><div><a href="/x">x</a><a href="/report/y">the longest title of all</a></div>'
    df = spark.createDataFrame([("https://a.b/news", page)], "url string, html string")
    got = discovery.cards(discovery.parsed_links(df)).collect()
    assert sorted((r.url, r.card_score) for r in got) == [("https://a.b/a", 2), ("https://a.b/b", 2), ("https://a.b/report/y", 5)]


def test_sitemap_budget_is_each_source_s(spark):
    maps = spark.createDataFrame([(m, f"<urlset>{''.join(f'<url><loc>https://{m}/{i}</loc></url>' for i in range(5))}</urlset>") for m in ("m1", "m2")], "map_url string, xml string")
    roots = spark.createDataFrame([("a", "m1"), ("b", "m2")], "source_name string, map_url string")
    got = feeds.sitemap_urls(maps, roots, most_urls=3).collect()
    assert sorted((r.source_name, r.url) for r in got) == [(s, f"https://{m}/{i}") for s, m in (("a", "m1"), ("b", "m2")) for i in range(3)]


def test_a_model_may_vouch_but_not_overrule(spark):
    """Verified facts and the model's are either enough; a summary needs all of them and the model's yes."""
    v = "struct(array('copper') as verified_metals, {day} as has_valid_same_day_date, true as has_market_context, '{kind}' as page_type, 900 as narrative_chars, 'low' as quote_signal)"
    said = "named_struct('is_relevant', {rel}, 'should_summarize', {sum}, 'target_metals', cast(array() as array<string>), 'same_day_valid', {day}, 'market_context', false, 'scope', '', 'reason', '')"
    cases = [
        (("true", "market_news"), ("false", "true", "false"), (True, True)), (("false", "market_news"), ("false", "true", "true"), (True, True)), (("false", "market_news"), ("false", "true", "false"), (True, False)),
        (("true", "market_news"), ("false", "false", "false"), (True, False)), (("true", "quote_page"), ("false", "true", "false"), (True, True)), (("false", "quote_page"), ("false", "true", "false"), (False, False)),
    ]
    for (day, kind), (rel, summ, mday), want in cases:
        df = spark.range(1).select(F.expr(v.format(day=day, kind=kind)).alias("verification"), F.expr(said.format(rel=rel, sum=summ, day=mday)).alias("model"), F.lit("Unknown").alias("scope"))
        r = df.select(acceptance.finalize_relevance(F.col("model"), CFG).alias("r")).first().r
        assert (r.is_relevant, r.should_summarize) == want, (day, kind, rel, summ, mday)


def test_shortlist_points(spark):
    def points(url, hint="", method="listing"):
        df = spark.createDataFrame([(url, "x", "", hint, method, 0)], "url string, title_hint string, snippet_hint string, published_hint string, method string, score int")
        return df.select(acceptance.shortlist_score(CFG)[1].alias("n")).first().n

    plain = points("https://a.b/c/story")
    # A written date counts as the day itself; a host that keeps old pages loses off the day; each way of finding cards counts.
    assert points("https://a.b/c/story", "April 7, 2026") - plain == 9 and points("https://a.b/c/story", "2 hours ago") - plain == 8
    assert points("https://www.reuters.com/c/story") - plain == -8 and points("https://a.b/c/story", method="dynamic_scrapy") - plain == 1


def test_titles_and_dates(spark):
    rows = [('<script type="application/ld+json">{"headline": "J"}</script><h1>H</h1><title>T</title>', "J"), ("<h1>H <b>x</b></h1><title>T</title>", "H x"), ("<title>T</title>", "T"), ("", "")]
    got = spark.createDataFrame([(n, h) for n, (h, _) in enumerate(rows)], "n int, h string").select("n", html.page_title("h").alias("t")).orderBy("n").collect()
    assert [r.t for r in got] == [t for _, t in rows]
    assert pd.notna(got[0].t)


def test_what_a_long_page_says_last_counts(spark, parts):
    """Of the visible text 12,000 characters were used, of all texts of a page together 16,000, of paragraphs put together 9,000, of a table 80 nodes."""
    from newslode.functions import dom

    told = "".join(f"<p>Paragraph {i} tells of nothing in particular, at some length and with no end.</p>" for i in range(400))
    long = f"<html><head><title>A long story</title></head><body><article>{told}</article><div>Copper market outlook, posted 3 minutes ago</div></body></html>"
    pages = spark.createDataFrame([("https://example.com/stories/long", long)], "url string, html string")
    assert pages.select(html.visible_text("html").alias("v")).first().v.endswith("posted 3 minutes ago")
    v = engine.judge(pages, parts[1], CFG).first().verification
    assert v.has_target_metal and v.has_market_context and v.has_valid_same_day_date
    own = pages.select(dom.tree("html").alias("t"), F.array(F.lit(".none")).alias("own")).withColumn("steps", dom.compiled("own"))
    body = own.select(dom.article_body(F.col("t"), F.lit("Metadata first"), F.col("own"), F.col("steps"), F.lit(100_000)).alias("b")).first().b
    assert "Paragraph 399" in body.text
    table = "<table>" + "<tr><td>12 cells</td></tr>" * 100 + "</table>" + told
    m = spark.createDataFrame([(table,)], "h string").select(html.narrative_metrics("h").alias("m")).first().m
    cells, seen = 3 * len(" ".join(["12 cells"] * 100)) + 2, len(" ".join(re.sub("<[^>]*>", " ", table).split()))
    assert m.table_density == round(cells / seen, 3)
