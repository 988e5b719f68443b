"""Hand-written cases of the column functions."""

import json

import pytest
from pyspark.sql import functions as F

from newslode.config import FIXTURE, PRODUCTION, Config
from newslode.functions import dom, dates, html, json_repair, lexicon, text, url


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def test_merge_modes(spark):
    a, b = F.lit("Copper rises"), F.lit("Copper rises as LME stocks fall")
    assert one(spark, text.merge_blocks(a, b, mode="first_wins"), text.merge_blocks(a, b), text.merge_blocks(a, F.lit("  "), F.lit(None).cast("string"), F.lit("x"))) == ("Copper rises", "Copper rises as LME stocks fall", "Copper rises\n\nx")


def test_space_truncate_key(spark):
    got = one(spark, text.normalize_space(F.lit(" a  b\n c ")), text.truncate_text(F.lit("one two three"), 9), text.truncate_text(F.lit("short"), 9), text.truncate(F.lit("abc def"), 4), text.first_nonempty(F.lit(None).cast("string"), F.lit(" "), F.lit(" x ")), F.length(text.stable_key(F.lit(None).cast("string"), F.lit("b"))))
    assert got == ("a b c", "one two...", "short", "abc...", "x", 40)


def test_points_sentences_fences(spark):
    got = one(spark, text.structured_points(F.lit("- a\n• b\n- a")), text.structured_points(F.lit("")), text.sentences(F.lit("A b. C d! E")), text.strip_fences(F.lit("```json\n{}\n```")), text.htmlize(F.lit("<a & 'b'>\n")), text.parse_names(F.lit("A;b\na,")), text.dedupe(F.array(F.lit("x "), F.lit("x"), F.lit(""))))
    assert got == (["a", "b"], [], ["A b.", "C d!", "E"], "{}", "&lt;a &amp; &#x27;b&#x27;&gt;<br>", ["a", "b"], ["x"])


@pytest.mark.parametrize(
    "u,norm,host",
    [("HTTP://User@Ex.COM:80/a/?q=1#f", "HTTP://User@Ex.COM:80/a", "ex.com"), ("", "", ""), (None, "", ""), ("mailto:a@b.c", "mailto:a@b.c", ""), ("https://a.b/", "https://a.b", "a.b")],
)
def test_url(spark, u, norm, host):
    c = F.lit(u).cast("string")
    assert one(spark, url.normalize_url(c), url.host_of(c)) == (norm, host)


def test_url_dates_and_kinds(spark):
    u = F.lit
    got = one(
        spark,
        F.date_format(url.url_date(u("https://a.b/2026/04/07/x")), "yyyy-MM-dd"), url.url_date(u("https://a.b/2026/13/40/x")), url.section_page(u("https://a.b/markets/")), url.section_page(u("https://a.b/x/y/news")), url.looks_like_article(u("https://a.b/tag/x")), url.looks_like_article(u("ftp://a.b/x")), url.looks_like_pdf(u("https://a.b/x.PDF?d=1")),
        url.old_archive(u("https://a.b/2025/01/02/x"), "2026-04-07"), url.old_archive(u("https://a.b/x"), "2026-04-07"), url.listing_url(u("https://a.b/l/?page=2&x=1&p=3#t")), url.join_url(u("https://a.b/c/d"), u("/e")), url.join_url(u("https://a.b/c/d"), u("e")), url.join_url(u("https://a.b"), u("//c.d/e")), url.host_suffixes(u("https://x.a.b/")), url.inferred_hosts(F.array(u("https://www.a.b/"))),
    )
    assert got == ("2026-04-07", None, True, False, False, False, True, True, False, "https://a.b/l/?page=2&p=3", "https://a.b/e", "https://a.b/c/e", "https://c.d/e", ["x.a.b", "a.b", "b"], ["a.b", "www.a.b"])


@pytest.mark.parametrize("raw,want", [("2026-04-07", "2026-04-07T00:00:00+00:00"), ("2026-04-07T10:00:00+02:00", "2026-04-07T08:00:00+00:00"), ("April 7, 2026", "2026-04-07T00:00:00+00:00"), ("Tue, 7 Apr 2026 10:00:00 +0000", "2026-04-07T10:00:00+00:00"), ("2 hours ago", ""), ("March 2026", ""), ("3m", ""), ("", ""), (None, "")])
def test_dates(spark, raw, want):
    assert one(spark, dates.parse_iso(F.lit(raw).cast("string"))) == (want,)


def test_hints_and_evidence(spark):
    day = "2026-04-07"
    ev = dates.date_evidence([("jsonld", F.lit("")), ("meta", F.lit("2026-04-06")), ("hint", F.lit("today")), ("url", F.lit("2026-04-07"))], day, day)
    none = dates.date_evidence([("a", F.lit("")), ("b", F.lit("soon"))], day, day)
    got = one(spark, dates.hint_matches(F.lit("2 hours ago"), day, day), dates.hint_matches(F.lit("today"), day, "2026-04-08"), dates.days_from(F.lit("x"), day), dates.days_from(F.lit("2026-04-05T01"), day), ev["published_at"], ev["same_day"], ev["checked"], none["published_at"], none["same_day"])
    assert got == (True, False, 999, 2, "2026-04-07T00:00:00+00:00", True, ["meta", "hint"], "", False)


def test_lexicon(spark):
    m = lambda t, lx=PRODUCTION: lexicon.mentions(F.lit(t), lx)
    got = one(spark, m("Copper and aluminium"), m("Cu cash price"), m("cupboard"), m("thor x", FIXTURE), m("thorn", FIXTURE), lexicon.scope(F.lit("Copper"), F.lit("aluminium"), PRODUCTION), lexicon.scope(F.lit("a"), F.lit("the lme"), PRODUCTION), lexicon.normalize_scope(F.lit("Copper, Aluminum")), lexicon.scope_matches(F.lit("Copper"), F.lit("Copper, Aluminum")), lexicon.stance(F.lit("bullish rebound pressure")), lexicon.stance(F.lit("bullish pressure")), lexicon.stance(F.lit("")), lexicon.digest_label(F.lit("Copper, Aluminum")), lexicon.canonical_targets(F.array(F.lit("CU"), F.lit("copper"), F.lit("tin"))))
    assert got == (["copper", "aluminum"], ["copper"], [], ["copper"], [], "Copper, Aluminum", "Broad Metals", "Copper, Aluminum", True, "Bullish", "Mixed", "Neutral", "Copper & Aluminium", ["copper"])


def test_html(spark):
    ld = '<script type="application/ld+json">' + json.dumps({"@graph": [{"headline": "H", "author": [{"name": "A"}], "datePublished": "2026-04-07", "articleBody": "long body"}]}) + "</script>"
    page = f'<html><head><title>T &amp; t</title><meta property="og:title" content="OG">{ld}</head><body><script>var t="</p>";</script><!-- x --><p>{"word " * 20}<p><b>{"other " * 20}<table><tr><td>1</td><td>2</td></tr></table><li>12345</li><a href="/x">go</a></body></html>'
    fields = html.jsonld_fields(html.jsonld_blocks(F.col("h")))
    df = spark.createDataFrame([(page,), (None,), ("",)], "h string")
    rows = df.select(fields.alias("f"), html.page_title("h").alias("t"), html.meta_content("h", "og:title").alias("m"), html.narrative_metrics("h").alias("n"), dom.anchors("h").alias("a")).collect()
    r = rows[0]
    assert (r.f.title, r.f.author, r.f.published, r.f.body, r.t, r.m) == ("H", "A", "2026-04-07", "long body", "H", "OG")
    assert (r.n.narrative_chars, r.n.narrative_paragraphs) == (99 + 119, 2) and r.n.table_density > 0
    assert [(a.href, a.anchor) for a in r.a] == [("/x", "go")]
    assert rows[1].n.narrative_chars == 0 and rows[1].a == [] and rows[2].t == ""


def test_quote_and_blocks(spark):
    q = html.quote_signal(F.lit("Futures prices per ton today"), F.lit("lme 3m cash bid ask open high low volume ab12 cd34 ef56"), F.lit("https://a.b/futures/x"))
    assert one(spark, q["signal"], html.quote_signal(F.lit("a"), F.lit("b"), F.lit("https://a.b/c"))["signal"], html.block_page(F.lit("Please verify you are  human")))[:2] == ("high", "low")


@pytest.mark.parametrize("raw,theme", [('```json\n{"theme": "x", "key_points": "one"}\n```', "x"), ("say {“theme”: “y”,} end", "y"), ('{"theme": , "stance": "bullish"}', ""), ("{} {", ""), (None, ""), ('{"theme": "a"} {"theme": "b"}', "a")])
def test_json_repair(raw, theme):
    got = json_repair.summary_of(raw)
    assert got["theme"] == theme and set(got) == set(json_repair.SUMMARY)


def test_config_is_frozen():
    with pytest.raises(AttributeError):
        Config().run_date = "x"
