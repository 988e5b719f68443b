"""The node tree, selectors, main text and dates against a walk over pages whose structure is known."""

import random

import pytest
from pyspark.sql import functions as F

from newslode.functions import dates, dom, html
from newslode.functions.text import BOILERPLATE
from newslode.sources import registry

CLASSES = ("content", "article-content", "box", "left", "rich-text")


def grown(rng, depth=0):
    """A random element: tag, attributes, children (elements or text)."""
    tag = rng.choice(("div", "section", "article", "main", "ul", "p", "h2", "span") if depth < 5 else ("p", "span"))
    attrs = {}
    if rng.random() < 0.4:
        attrs["class"] = " ".join(rng.sample(CLASSES, rng.randint(1, 2)))
    if rng.random() < 0.2:
        attrs["role"] = rng.choice(("main", "menu"))
    if tag in ("p", "span", "h2"):
        return (tag, attrs, [f"{rng.choice(('Text', 'Words', 'Subscribe now'))} {rng.randrange(40)} " + "more of it " * rng.randrange(6)])
    kids = [grown(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    if tag == "ul":
        kids = [("li", {}, [f"Item {rng.randrange(9)} " + "and so on " * rng.randrange(5)]) for _ in range(3)]
    return (tag, attrs, kids)


def written(node, rng):
    tag, attrs, kids = node
    inner = "".join(k if isinstance(k, str) else written(k, rng) for k in kids)
    end = "" if tag == "li" and rng.random() < 0.5 else f"</{tag}>"  # an item may be left open
    return f"<{tag}{''.join(f' {k}={chr(34)}{v}{chr(34)}' for k, v in attrs.items())}>{inner}{end}"


def flat(node, above=(), before=None):
    """Every element with those above it and its elder sibling, in the order of the page."""
    out = [(node, above, before)]
    elder = None
    for k in node[2]:
        if not isinstance(k, str):
            out += flat(k, (*above, node), elder)
            elder = k
    return out


def text_of(node):
    return " ".join(filter(None, (" ".join((k if isinstance(k, str) else text_of(k)).split()) for k in node[2])))


def has(node, sel):
    tag, attrs, _ = node
    if sel.startswith("."):
        return sel[1:] in attrs.get("class", "").split()
    if sel.startswith("["):
        return attrs.get("role") == "main"
    return tag == sel


def told(texts, least=30):
    out, seen = [], set()
    for t in texts:
        if len(t) >= least and not any(b in t.lower() for b in BOILERPLATE) and t.lower() not in seen:
            seen.add(t.lower())
            out.append(t)
    return "\n".join(out)


def expected(root, least):
    every = flat(root)
    for sel in dom.BODY_SCOPES:
        got = told(text_of(n) for n, above, _ in every if n[0] in ("p", "li") and any(has(a, sel) for a in above))
        if len(got) >= least:
            return got, f"css:{sel}"
    rest = told((text_of(n) for n, _, _ in every if n[0] == "p"), 40)
    return rest, "paragraphs" if rest else "empty"


@pytest.fixture(scope="module")
def forest():
    rng = random.Random(3)
    return [("body", {}, [grown(rng) for _ in range(4)]) for _ in range(60)], rng


@pytest.fixture(scope="module")
def trees(spark, forest):
    pages, rng = forest
    rows = [(i, "<html>" + written(p, rng) + "</html>") for i, p in enumerate(pages)]
    return spark.createDataFrame(rows, "i int, html string").withColumn("t", dom.tree("html"))


def test_main_text(trees, forest):
    got = {r.i: (r.m.text, r.m.method) for r in trees.select("i", dom.main_text(F.col("t"), 120).alias("m")).collect()}
    assert got == {i: expected(p, 120) for i, p in enumerate(forest[0])}
    assert len({m for _, m in got.values()}) > 4


def test_selectors(trees, forest):
    """Descendants, children, siblings, classes, attributes; known to the plan and as data."""
    css = ["div .left", "div > p", "h2 + p", "section.box", "[role=main] p", "[class*='cont']", "div.left > section p", "ul, h2"]

    def want(page):
        every = flat(page)
        cls = lambda n: n[1].get("class", "").split()
        tests = [
            lambda n, up, b: "left" in cls(n) and any(a[0] == "div" for a in up),
            lambda n, up, b: n[0] == "p" and up and up[-1][0] == "div",
            lambda n, up, b: n[0] == "p" and b and b[0] == "h2",
            lambda n, up, b: n[0] == "section" and "box" in cls(n),
            lambda n, up, b: n[0] == "p" and any(a[1].get("role") == "main" for a in up),
            lambda n, up, b: "cont" in n[1].get("class", ""),
            lambda n, up, b: n[0] == "p" and any(a[0] == "section" and j and up[j - 1][0] == "div" and "left" in cls(up[j - 1]) for j, a in enumerate(up)),
            lambda n, up, b: n[0] in ("ul", "h2"),
        ]
        return [sum(bool(t(*x)) for x in every) for t in tests]

    nodes = F.col("t")["nodes"]
    known = F.array(*[F.size(dom.select(nodes, s)) for s in css])
    single = trees.withColumn("s", F.array(*map(F.lit, css[:-1]))).withColumn("steps", dom.compiled("s"))
    rows = single.select("i", known.alias("a"), F.transform("steps", lambda s: F.size(dom.select_by(nodes, s))).alias("b")).collect()
    for r in rows:
        assert list(r.a) == want(forest[0][r.i])
        assert list(r.b) == list(r.a)[:-1]


def test_broken_pages(spark):
    """Unclosed and crossing elements, void ones, scripts, null and empty pages."""
    pages = [("<p>one<p>two <b>bold<p>three", ["one", "two bold", "three"]), ("<div><p>a<br>b</div><p>c</span>d", ["a b", "c d"]), ("<ul><li>x<ul><li>y</ul><li>z</ul>", []), ("<script><p>no</p></script><p>yes", ["yes"]), (None, []), ("", [])]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(pages)], "i int, h string").withColumn("t", dom.tree("h"))
    got = df.select("i", F.transform(dom._blocks(F.col("t")["nodes"], "p"), lambda n: dom.text_of(F.col("t"), n)).alias("p"), F.transform(dom._blocks(F.col("t")["nodes"], "li"), lambda n: dom.text_of(F.col("t"), n)).alias("li")).orderBy("i").collect()
    assert [list(r.p) for r in got] == [p for _, p in pages]
    assert list(got[2].li) == ["x y", "y", "z"]
    for bad in ("", "p[", "a::before", "!"):
        with pytest.raises(ValueError):
            dom.compile_selector(bad)


def test_body_rescue_and_profiles(spark):
    """One page, several sources: each source's own selectors; metadata; all together where nothing is long enough."""
    page = "<article><h2>Head</h2><p>A lead of over twenty characters</p></article><div class='a'><p>" + "The first box tells this. " * 8 + "</div><div class='b'><p>" + "The second box tells that. " * 6 + "</div>"
    sources = registry.from_specs(spark, [{"source_name": n, "article_body_selectors": s, "min_body_chars": 4000} for n, s in (("x", [".a"]), ("y", [".b"]), ("Reuters", None))])
    assert {r.source_name: list(r.article_body_selectors) for r in sources.collect()}["Reuters"][0] == "main article"
    rows = sources.withColumn("html", F.lit(page)).withColumn("t", dom.tree("html"))
    short = rows.select("source_name", dom.article_body(F.col("t"), F.lit(""), F.col("article_body_selectors"), F.col("body_steps"), F.lit(300)).alias("b")).collect()
    by = {r.source_name: r.b for r in short}
    assert by["x"].text.startswith("The first") and by["Reuters"].method == "paragraphs"
    profile = {r.source_name: r.p for r in rows.select("source_name", dom.profile_text(F.col("t"), F.col("article_body_selectors"), F.col("body_steps"), F.lit(100)).alias("p")).collect()}
    assert profile["x"].method == "profile:.a" and profile["y"].text.startswith("The second") and profile["Reuters"].method == ""
    ld = rows.select(dom.article_body(F.col("t"), F.lit("J" * 900), F.col("article_body_selectors"), F.col("body_steps"), F.lit(1000)).alias("b")).first().b
    assert (ld.method, len(ld.text)) == ("jsonld_body", 900)
    lead = rows.select(dom.lead_text(F.col("t")).alias("x")).first().x
    assert lead == "A lead of over twenty characters"
    whole = rows.select("source_name", dom.article_body(F.col("t"), F.lit("Metadata tells a little of it"), F.col("article_body_selectors"), F.col("body_steps"), F.lit(4000)).alias("b")).where("source_name = 'y'").first().b
    assert "A lead of" in whole.text and "The first box" in whole.text and "Metadata" in whole.text


def test_dates(spark):
    page = "<meta name='date' content=''><meta property='og:published_time' content='2026-04-01'><header><time>April 2, 2026</time></header><article>" + "".join(f"<time datetime='2026-03-{d:02}'>x</time>" for d in range(1, 20)) + "<span class='updated' title='2026-04-07'>now</span></article>"
    df = spark.createDataFrame([(page,)], "h string").withColumn("t", dom.tree("h"))
    found = df.select(dom.page_evidence(F.col("t"), F.array(F.lit("2026-01-01"), F.lit("")), F.lit("today"), F.lit("")).alias("e"))
    e = [(x.label, x.value) for x in found.first().e]
    days = [f"2026-03-{d:02}" for d in range(1, 20)]
    shown = ["April 2, 2026", *days[:12], "April 2, 2026", *days[:11], "2026-04-07", "2026-04-07"]  # "updated" holds "date" as well
    assert e == [("jsonld", "2026-01-01"), ("meta:og:published_time", "2026-04-01"), *[("visible_date_selector", v) for v in shown], ("node_time_tags", "2026-03-01"), ("candidate_published_hint", "today")]
    got = found.select(dates.ranked_evidence(F.col("e"), "2026-04-07", "2026-04-09").alias("r")).first().r
    assert (got.published_at[:10], got.same_day, len(got.checked)) == ("2026-04-07", True, 1 + len(shown))
    none = found.select(dates.ranked_evidence(F.slice("e", 1, 3), "2026-04-07", "2026-04-07", F.lit("told 3 minutes ago")).alias("r")).first().r
    assert (none.published_at[:10], none.same_day, none.checked[-1]) == ("2026-01-01", True, "visible_relative_text")
    blocks = F.array(F.lit('[{"datePublished": "a"}, {"dateModified": "b", "@graph": [{"datePublished": "c"}]}]'), F.lit("{no json"))
    assert list(df.select(html.jsonld_dates(blocks).alias("d")).first().d) == ["b", "c", "a"]


def test_anchors(spark):
    """Titles by the anchor's own words, then the container's heading, then the text; snippets of the container; the nearest container."""
    page = """<a href='/top'>Top</a><div><h2 aria-label='Said aloud'>Box heading</h2><span><a href='/empty'><img></a></span><p>A paragraph of the box that is read.</p><p>a paragraph of the box that is READ.</p><p>Subscribe to our newsletter today</p>
    <section><a href='/inner' title='Own title' data-summary='Own words of it'>inner</a><b class='dek'>A dek</b><time>April 7, 2026</time></section></div>
    <li><a href='/plain'>Only a text</a> and more <time datetime='2026-04-07'>x</time></li><a>no href</a><li><a href='/long'>x</a>""" + " word" * 200 + "</li>"
    got = [tuple(a)[1:6] for a in spark.createDataFrame([(page,)], "h string").select(dom.anchors("h").alias("a")).first().a]
    told = "A paragraph of the box that is read."
    assert got[0] == ("/top", "Top", "Top", "", "")
    assert got[1] == ("/empty", "Box heading", "Said aloud", "A dek " + told, "April 7, 2026")
    assert got[2] == ("/inner", "inner", "Own title", "Own words of it A dek", "April 7, 2026")
    assert got[3] == ("/plain", "Only a text", "Only a text", "Only a text and more x", "2026-04-07")
    assert got[4][:3] == ("/long", "x", "x") and len(got[4][3]) <= 363 and got[4][3].endswith(" word...")
    assert [a.box for a in spark.createDataFrame([(page,)], "h string").select(dom.anchors("h").alias("a")).first().a][0] == 0
    assert spark.createDataFrame([(None,), ("",)], "h string").select(dom.anchors("h").alias("a")).collect() == [([],), ([],)]
