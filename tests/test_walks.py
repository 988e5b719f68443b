"""Budgets, gates and quotas against the walks they stand for, in plain Python."""

import collections
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from newslode.operators import discovery, ranking
from newslode.plans import engine
from newslode.plans.catalogue import CFG
from newslode.sources import registry

EDGES = "source_name string, src string, dst string, rank int"


def walked(edges, seeds, depth, budget, follow):
    """The queue."""
    out = []
    links = collections.defaultdict(list)
    for source, src, dst, rank in sorted(edges, key=lambda e: (e[3], e[2])):
        links[source, src].append(dst)
    for source in sorted({s[0] for s in seeds}):
        queue = collections.deque((u, 0) for _, u, o in sorted(seeds, key=lambda s: (s[2], s[1])) if _ == source)
        seen = []
        while queue and len(seen) < budget:
            url, d = queue.popleft()
            if url in seen:
                continue
            seen.append(url)
            out.append((source, url, d, len(seen)))
            if d < depth:
                queue.extend((x, d + 1) for x in links[source, url][:follow] if x not in seen)
    return sorted(out)


@pytest.mark.parametrize("depth, budget, follow", [(2, 30, 20), (3, 12, 3), (1, 5, 2), (0, 2, 2)])
def test_budgeted_traversal_is_the_queue(spark, depth, budget, follow):
    rng = random.Random(depth)
    edges = list({(s, f"u{rng.randrange(40)}", f"u{rng.randrange(60)}"): None for s in ("a", "b") for _ in range(300)})
    edges = [(*e, n % 7) for n, e in enumerate(edges)] + [("a", "hub", f"v{n}", n) for n in range(200)]  # a hub of many links
    seeds = [("a", "u1", 2), ("a", "hub", 1), ("a", "u1", 5), ("b", "u2", 0), ("b", "u3", 0), ("c", "nowhere", 0)]
    kept = []

    def keep(df, name):
        kept.append(engine.written(df, name))
        return kept[-1]

    got = discovery.budgeted_traversal(spark.createDataFrame(edges, EDGES), spark.createDataFrame(seeds, "source_name string, url string, ord int"), depth, budget, follow, keep)
    assert sorted((r.source_name, r.url, r.depth, r.place) for r in got.collect()) == walked(edges, seeds, depth, budget, follow)
    assert len(kept) == depth + 1


def test_stages_are_gated_by_source(spark):
    """One source has enough, one is short of the search threshold, one is short and of another role, one has nothing."""
    sources = spark.createDataFrame([("full", "narrative_news"), ("short", "market_data"), ("report", "market_research"), ("none", "narrative_news")], "source_name string, source_role string")
    kind = "source_name string, url string, title_hint string, snippet_hint string, published_hint string, method string, score int, ord long"
    rows = lambda name, source, n: [(source, f"http://{source}/{name}{i}", "", "", "", name, 1, i) for i in range(n)]
    every = ("full", "short", "report", "none")
    base = discovery.union_stages({"rss": spark.createDataFrame(rows("rss", "full", 5) + rows("rss", "short", 2) + rows("rss", "report", 1) + rows("rss", "short", 2), kind)})
    search = spark.createDataFrame([r for s in every for r in rows("search", s, 2)], kind)
    outside = spark.createDataFrame([r for s in every for r in rows("outside", s, 9)], kind)
    got = discovery.gated(base, sources, replace(CFG, search_threshold=5, outside_threshold=4), search, outside)
    n = {(r.source_name, r.stage): r["count"] for r in got.groupBy("source_name", "stage").count().collect()}
    assert n == {("full", "rss"): 5, ("short", "rss"): 4, ("short", "search"): 2, ("report", "rss"): 1, ("report", "external"): 9, ("none", "search"): 2, ("none", "external"): 9}


def listed_by_the_walk(rows, cap, limit, threshold, backfill, out_cap, out_limit, floor):
    """rows of one source: (url, score, is_pdf, is_report, ord, is_outside, signal)."""
    has = any(r[5] for r in rows)
    if has:
        threshold, cap, limit = min(threshold, 0), max(cap, out_cap), max(limit, out_limit)
    floor = min(limit, floor)
    ordered = sorted((r for r in rows), key=lambda r: (r[2], -r[1], r[4]))
    short, pool = [], []
    for r in ordered:
        if r[1] >= threshold:
            short.append(r)
        elif r[1] >= backfill or r[3]:
            pool.append(r)
        if len(short) >= cap:
            break
    if has and len(short) < floor:
        for r in ordered:
            if r not in short and r[6]:
                short.append(r)
                if len(short) >= floor:
                    break
    preferred = max(6, limit // 2, floor if has else 0)
    html, pdf = [r for r in short if not r[2]], [r for r in short if r[2]]
    out = html[:preferred]
    if len(out) < limit:
        out += [r for r in pool if not r[2]][: limit - len(out)]
    if len(out) < limit and len(html) < preferred:
        out += pdf[: limit - len(out)]
    if len(out) < limit:
        out += [r for r in pool if r[2]][: limit - len(out)]
    return list(dict.fromkeys(r[0] for r in out[:limit]))


@pytest.mark.parametrize("seed", range(4))
def test_outside_quota_is_the_walk(spark, seed):
    rng = random.Random(seed)
    rows = []
    for s in range(12):
        outside = rng.random() < 0.6
        level = rng.choice((-6, -2, 1))
        for i in range(rng.choice((3, 15, 60))):
            rows.append((f"s{s}", f"u{s}-{i}", rng.randrange(level, level + 8), rng.random() < 0.3, rng.random() < 0.1, i, outside and rng.random() < 0.3, rng.random() < 0.4))
    df = spark.createDataFrame(rows, "source_name string, url string, points int, is_pdf boolean, is_report boolean, ord int, is_out boolean, sig boolean")
    quota = ranking.Outside(F.col("is_out"), F.col("sig"), 9, 14, 8)
    got = collections.defaultdict(list)
    for r in ranking.shortlist(df, F.col("points"), 6, 12, 3, 1, quota).orderBy("list_rank").collect():
        got[r.source_name].append(r.url)
    want = {s: listed_by_the_walk([r[1:] for r in rows if r[0] == s], 6, 12, 3, 1, 9, 14, 8) for s in sorted({r[0] for r in rows})}
    assert dict(got) == {s: v for s, v in want.items() if v}


def test_page_and_source_do_not_depend_on_order(spark):
    """Two copies of a page, in either order, give one article; nested hosts go to the longest, then to the first by name."""
    page = lambda word: "<h1>Copper " + word + "</h1><article>" + "".join(f"<p>Copper prices on the market rise again, {word} {n} says, while stocks fall.</p>" for n in range(9)) + "</article>"
    copies = [("https://news.metals.example.com/a/2026/04/07/copper-rises", page("first!")), ("https://news.metals.example.com/a/2026/04/07/copper-rises", page("second"))]
    sources = registry.from_specs(spark, [{"source_name": n, "allowed_hosts": h, "min_body_chars": 200} for n, h in (("wide", ["example.com"]), ("z", ["metals.example.com"]), ("near", ["metals.example.com", "x.org"]))])
    found = []
    for rows in (copies, copies[::-1]):
        judged = engine.judge(spark.createDataFrame(rows, "url string, html string").coalesce(1), sources, CFG).select("title", "source_name", "extraction_method").collect()
        found.append([tuple(r) for r in judged])
    assert found[0] == found[1] and len(found[0]) == 1
    assert found[0][0][1:] == ("near", "css:article")


def test_a_round_orders_only_the_links_it_begins_at(spark):
    """The links of all pages were ordered and cut in every round."""
    plans = []

    def keep(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    edges = spark.createDataFrame([("a", "u1", "u2", 0)], EDGES)
    discovery.budgeted_traversal(edges, spark.createDataFrame([("a", "u1", 0)], "source_name string, url string, ord int"), 1, 5, 2, keep)
    assert "LeftSemi" in plans[1]
