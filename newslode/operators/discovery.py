"""Candidates from listings, feeds, searches and links between pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import Config
from ..functions import dom as N
from ..functions import url as U
from ..functions.text import normalize_space, text
from . import acceptance as A
from .ranking import merge_candidates, top_per

STAGES = ("seed", "rss", "sitemap", "traversal", "search", "external")
PROVIDERS = {"google": "https://www.google.com/search?q=", "bing": "https://www.bing.com/search?q=", "duckduckgo": "https://duckduckgo.com/html/?q="}


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """listing_url, ord, url, anchor of every anchor that a pattern can read."""
    found = F.regexp_extract_all(F.col(html), F.lit('<a href="([^"]*)">([^<]*)</a>'), F.lit(0))
    rows = pages.select(F.col(url).alias("listing_url"), F.posexplode(found).alias("ord", "a"))
    href = F.regexp_extract("a", '<a href="([^"]*)">', 1)
    return rows.select("listing_url", "ord", U.join_url("listing_url", href).alias("url"), normalize_space(F.regexp_extract("a", ">([^<]*)</a>", 1)).alias("anchor"))


def parsed_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The same by a parser, with the text and time around each anchor."""
    rows = pages.select(F.col(url).alias("listing_url"), F.explode(N.anchors(F.col(html))).alias("a"))
    return rows.select("listing_url", "a.ord", U.join_url("listing_url", F.col("a.href")).alias("url"), "a.anchor", "a.title", "a.snippet", "a.published", "a.box")


def listing_candidates(found: DataFrame, sources: DataFrame, cfg: Config, method: str = "listing", most: int | None = None) -> DataFrame:
    """Accepted links of each source's listings as candidates. sources is a small table: its join is a broadcast."""
    hosts = sources.withColumn("host", F.explode("allowed_hosts"))
    at = found.withColumn("host", F.explode(U.host_suffixes("url")))
    rows = at.join(F.broadcast(hosts), "host").where(A.source_accepts(F.col("url"), cfg))
    pdf = F.when(U.looks_like_pdf("url"), 3).otherwise(0)
    scored = rows.select("source_name", U.normalize_url("url").alias("url"), "listing_url", F.col("anchor").alias("title_hint"), text("published").alias("published_hint"), text("snippet").alias("snippet_hint"), F.lit(method).alias("method"), (A.anchor_candidate_score(F.col("url"), F.col("anchor"), F.col("snippet"), cfg) + pdf).alias("score"), F.col("ord"))
    return top_per(scored, ["source_name"], [F.col("score").desc(), F.col("url"), F.col("ord")], most).drop("rank") if most else scored


def cards(found: DataFrame) -> DataFrame:
    """Of each container its best anchor, of equals the first: two more for a report or PDF, one for a title of 14 characters."""
    score = F.when(U.looks_like_pdf("url") | U.looks_like_report("url"), 2).otherwise(0) + F.when(F.length("anchor") >= 14, 1).otherwise(0)
    return found.withColumn("card_score", score + 2).groupBy("listing_url", "box").agg(F.max_by(F.struct("snippet", "url", "anchor", "published", "card_score"), F.struct(F.col("card_score"), -F.col("ord"))).alias("c")).select("listing_url", "box", "c.*")


def section_pages(found: DataFrame, most: int = 4) -> DataFrame:
    rows = found.where(U.section_page("url")).withColumn("url", U.normalize_url("url")).dropDuplicates(["listing_url", "url"])
    return top_per(rows, ["listing_url"], [F.col("ord"), F.col("url")], most)


def pagination_links(found: DataFrame, most: int = 2) -> DataFrame:
    return top_per(found.where(U.pagination_link("url", "anchor")).withColumn("url", U.listing_url("url")).dropDuplicates(["listing_url", "url"]), ["listing_url"], [F.col("ord"), F.col("url")], most)


def union_stages(stages: dict[str, DataFrame]) -> DataFrame:
    """Candidates of all stages in their fixed order; stage_ord and ord give merges a total order."""
    out = None
    for name, df in stages.items():
        own = df.withColumn("stage", F.lit(name)).withColumn("stage_ord", F.lit(STAGES.index(name)))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def with_source(rows: DataFrame, sources: DataFrame, url: str = "source_url") -> DataFrame:
    """Each row beside its source: the one whose allowed host is the longest that holds the url's, of equals the first by name.

    Hosts are matched once each, so no row is doubled and no pick depends on the order of rows.
    """
    hosts = sources.select("source_name", F.explode("allowed_hosts").alias("allowed_host"))
    seen = rows.select(F.col(url).alias("any_url")).withColumn("row_host", U.host_of("any_url")).groupBy("row_host").agg(F.min("any_url").alias("any_url"))
    found = seen.withColumn("suffix", F.explode(U.host_suffixes("any_url"))).join(hosts, F.col("suffix") == F.col("allowed_host"))
    owner = found.groupBy("row_host").agg(F.min_by("source_name", F.struct(-F.length("suffix"), "source_name")).alias("owner"))
    own = rows.withColumn("row_host", U.host_of(url)).join(owner, "row_host").withColumnRenamed("owner", "source_name").drop("row_host")
    return own.join(sources, "source_name")


def short_of(found: DataFrame, sources: DataFrame, threshold: int) -> DataFrame:
    """Names of the sources with fewer different urls than the threshold, those without any included."""
    n = found.groupBy("source_name").agg(F.countDistinct("url").alias("n_urls"))
    return sources.join(n, "source_name", "left").where(F.coalesce("n_urls", F.lit(0)) < threshold).select("source_name", "source_role")


def gated(base: DataFrame, sources: DataFrame, cfg: Config, search: DataFrame | None = None, outside: DataFrame | None = None) -> DataFrame:
    """Candidates (source_name, url, ...) of the ready stages, and for each source that they leave short the results of the search
    engines, if its role is one they serve, then, if it still is short, the outside ones. Each source goes by its own count."""
    out = base
    for more, stage, threshold, roles in ((search, "search", cfg.search_threshold, ("narrative_news", "market_data")), (outside, "external", cfg.outside_threshold, None)):
        if more is None:
            continue
        few = short_of(out, sources, threshold)
        few = few.where(F.col("source_role").isin(*roles)) if roles else few
        out = out.unionByName(union_stages({stage: more.join(few.select("source_name"), "source_name", "left_semi")}), allowMissingColumns=True)
    return out


def discover(stages: dict[str, DataFrame], sources: DataFrame, cfg: Config, outside: DataFrame | None = None, search: DataFrame | None = None) -> DataFrame:
    """Candidates merged by source and url, beside their source. Stages give urls, whose host tells the source; search and outside rows name their source."""
    base = with_source(union_stages(stages), sources, "url").select("source_name", *union_stages(stages).columns)
    found = gated(base, sources, cfg, search, outside)
    return merge_candidates(found, ("source_name", "url")).join(sources, "source_name")


def reachable(edges: DataFrame, seeds: DataFrame, depth: int = 2) -> DataFrame:
    """url, depth: pages reached from the seeds over edges (src, dst) in at most `depth` steps, by the shortest way."""
    steps = edges.select(F.col("src").alias("from_url"), F.col("dst").alias("to_url"))
    reached = seeds.select("url", F.lit(0).alias("depth")).distinct()
    for step in range(1, depth + 1):
        front = reached.where(F.col("depth") == step - 1).select(F.col("url").alias("at"))
        new = front.join(steps, F.col("at") == F.col("from_url")).select(F.col("to_url").alias("url"), F.lit(step).alias("depth"))
        reached = reached.unionByName(new).groupBy("url").agg(F.min("depth").alias("depth"))
    return reached


def budgeted_traversal(edges: DataFrame, seeds: DataFrame, depth: int = 2, budget: int = 30, follow: int = 20, keep=lambda df, name: df) -> DataFrame:
    """source_name, url, depth, place: the pages a source's walk visits, in the order of a queue.

    edges: source_name, src, dst, rank (the order of a page's links), only those that may be visited; seeds: source_name, url, ord.
    A page gives its first links, each page is visited once, and a source's walk ends with its budget. A level
    of the queue is one round: its order is that of the pages it comes from, then that of their links; what was
    seen before is taken out by an anti join. keep(df, name) writes the visited pages between the rounds.
    Only the links of pages that a round begins at are ordered and cut, never those of all pages.
    """
    by_source = lambda *order: F.row_number().over(Window.partitionBy("source_name").orderBy(*order))
    first = seeds.groupBy("source_name", "url").agg(F.min("ord").alias("ord")).withColumn("place", by_source("ord", "url")).where(F.col("place") <= budget)
    visited = keep(first.select("source_name", "url", F.lit(0).alias("depth"), "place"), "visited")
    for step in range(1, depth + 1):
        front = visited.where(F.col("depth") == step - 1).select("source_name", F.col("url").alias("at"), F.col("place").alias("from_place"))
        own = edges.join(front.select("source_name", F.col("at").alias("src")), ["source_name", "src"], "left_semi")
        links = top_per(own, ["source_name", "src"], [F.col("rank"), F.col("dst")], follow, "turn").select("source_name", F.col("src").alias("at"), "dst", "turn")
        new = front.join(links, ["source_name", "at"]).groupBy("source_name", F.col("dst").alias("url")).agg(F.min(F.struct("from_place", "turn")).alias("turn"))
        new = new.join(visited.select("source_name", "url"), ["source_name", "url"], "left_anti")
        spent = visited.groupBy("source_name").agg(F.max("place").alias("spent"))
        new = new.join(spent, "source_name").withColumn("place", by_source("turn", "url") + F.col("spent")).where(F.col("place") <= budget)
        visited = keep(visited.unionByName(new.select("source_name", "url", F.lit(step).alias("depth"), "place")), "visited")
    return visited


def follow_links(found: DataFrame, cfg: Config, keywords: Column, most: int = 20) -> DataFrame:
    """Of each page the links most worth following; found carries the source's columns."""
    score = A.traversal_score(F.col("url"), F.col("anchor"), cfg, keywords, F.col("include_hints"), A.source_accepts(F.col("url"), cfg))
    rows = found.where(A.follow(F.col("url"), F.col("anchor"), cfg, keywords)).withColumn("follow_score", score).withColumn("url", U.listing_url("url"))
    return top_per(rows, ["listing_url"], [F.col("follow_score").desc(), F.col("ord"), F.col("url")], most)


def host_join(pages: DataFrame, hosts: DataFrame, url: str = "url") -> DataFrame:
    """Pages whose host is listed or lies under a listed one: an equi-join over the host's suffixes in the place of a suffix test."""
    return pages.withColumn("suffix", F.explode(U.host_suffixes(url))).join(hosts, F.col("suffix") == F.col("allowed_host")).drop("suffix")


def alias_join(names: DataFrame, terms: DataFrame) -> DataFrame:
    """Names and term keys of which one holds the other. terms is a fixed table of some dozens of rows."""
    a, b = F.lower("name"), F.lower("key")
    return names.join(F.broadcast(terms), F.contains(a, b) | F.contains(b, a))


def provider_alias(x) -> Column:
    low = F.lower(F.trim(text(x)))
    return F.when(low.isin("ddg", "duckduckgo", "duck"), "duckduckgo").when(low.isin("bing", "msn"), "bing").otherwise("google")


def search_requests(hosts: DataFrame, providers: tuple[str, ...], terms: tuple[str, ...], day: str) -> DataFrame:
    """Every host with each of the given providers and terms."""
    from ..functions.dates import query_tokens

    each = lambda values: F.explode(F.array(*[F.lit(v) for v in values]))
    rows = hosts.withColumn("provider", each(providers)).withColumn("term", each(terms))
    query = F.concat(F.lit("site:"), F.col("host"), F.lit(" "), F.col("term"), F.lit(" "), F.element_at(query_tokens(day), 2))
    base = F.lit(None).cast("string")
    for name, url in PROVIDERS.items():
        base = F.when(F.col("provider") == name, F.lit(url)).otherwise(base)
    return rows.withColumn("query", query).withColumn("request_url", F.concat(base, F.url_encode(query)))


def unwrap_result(href) -> Column:
    """The target of a search engine's redirect link."""
    wrapped = F.regexp_extract(text(href), r"[?&](?:q|uddg|u)=([^&]*)", 1)
    return F.when((wrapped != "") & F.regexp_like(text(href), F.lit(r"/url\?|/l/\?|[?&]uddg=")), F.coalesce(F.try_url_decode(wrapped), wrapped)).otherwise(text(href))


def search_candidates(results: DataFrame, cfg: Config, per_query: int = 6) -> DataFrame:
    """Results (source_name, query, rank, url, title, snippet) that name a target: five more, two for a title hit, four for the day."""
    from ..functions import lexicon as L

    url = unwrap_result("url")
    blob = F.concat_ws(" ", text("title"), text("snippet"), url)
    day = F.contains(F.concat_ws(" ", text("title"), text("snippet")), F.lit(cfg.target_date)) | U.same_day_url(url, cfg.target_date)
    score = L.candidate_score("title", url, "snippet", cfg) + 5 + F.when(L.has_target("title", cfg.lexicon), 2).otherwise(0) + F.when(day, 4).otherwise(0)
    rows = results.withColumn("score", score).withColumn("target", url).where(L.has_target(blob, cfg.lexicon))
    return top_per(rows, ["source_name", "query"], [F.col("rank_no"), F.col("target")], per_query)


def selected_sources(sources: DataFrame, requested: DataFrame) -> DataFrame:
    """Sources asked for by name, regardless of case; all if none of the names is known."""
    chosen = sources.join(F.broadcast(requested.select(F.lower(F.trim("name")).alias("want"))), F.lower("source_name") == F.col("want"), "left_semi")
    return sources if chosen.isEmpty() else chosen


def fallback_sources(sources: DataFrame, selected: DataFrame, names: DataFrame) -> DataFrame:
    """Known fallbacks that weren't selected."""
    return sources.join(F.broadcast(names), sources.source_name == names.name, "left_semi").join(selected.select("source_name"), "source_name", "left_anti")
