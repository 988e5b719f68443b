"""Packets and prompts for models, default terms, empty sections."""

import json

from pyspark.sql import functions as F
from test_operators import story_pages

from newslode.operators import summary
from newslode.plans import engine
from newslode.plans.catalogue import CFG
from newslode.sources import registry


def test_relevance_prompt_of_judged_articles(spark):
    judged = engine.judge(story_pages(spark, ["a-story"]), registry.fixture(spark), CFG)
    row = judged.select(summary.relevance_prompt(CFG).alias("p"), summary.evidence_packet(CFG).alias("e"), "acceptance.score", "source_role").first()
    told = json.loads(row.p)
    assert len(told["rules"]) == 6 and told["valid_scopes"][2] == "Copper, Aluminum"
    packet = told["packet"]
    assert len(packet) == 21 and packet["acceptance_score"] == row.score and packet["source_role"] == row.source_role == row.e.source_role
    assert packet["structure_override_possible"] is False and packet["target_date"] == CFG.target_date
    assert len(row.e.asDict()) == 14 and row.e.extraction_method and len(packet["excerpt_for_model"]) <= 2603


def test_default_terms(spark):
    rows = [("LME", ["https://x.org"]), ("Plain", None), ("Shop", ["https://www.investing.com/a", "https://metal.com"])]
    df = spark.createDataFrame(rows, "source_name string, seed_urls array<string>")
    c, s = registry.default_terms("source_name", F.col("seed_urls"))
    got = {r.source_name: (list(r.c), list(r.s)) for r in df.select("source_name", c.alias("c"), s.alias("s")).collect()}
    assert got["Plain"] == (list(registry.EVERY_CATEGORY), list(registry.EVERY_SEARCH))
    assert got["LME"][0][-2:] == ["non-ferrous", "market data"]
    assert got["Shop"][1][-3:] == ["copper commodity price", "copper futures", "commodity market data"] and "smm analysis" in got["Shop"][1]
    given = registry.from_specs(spark, [{"source_name": "a", "category_terms": ["Own"]}, {"source_name": "b", "category_terms": []}, {"source_name": "c"}])
    assert {r.source_name: len(r.category_terms) for r in given.collect()} == {"a": 1, "b": 0, "c": 7}


def test_empty_sections_say_so(spark):
    groups = spark.createDataFrame([("Copper", "price", 1, "A point of the day", "S", "")], "label string, section string, place int, text string, source string, url string")
    page = summary.digest_html(groups, "x").first().html
    assert page.count(summary.NO_SIGNAL) == len(summary.SECTIONS) - 1 and page.count("<h3>") == len(summary.SECTIONS)


def test_sources_used(spark):
    rows = spark.createDataFrame([(f" S{i % 11} ", i) for i in range(40)] + [("", -1), (None, -2)], "SourceName string, ord int")
    assert [r.source for r in summary.sources_used(rows).orderBy("place").collect()] == [f"S{i}" for i in range(8)]
