"""The daily run as one plan: pages and sources in, brief rows out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import dom as N
from ..functions import html as H
from ..functions import lexicon as L
from ..functions import url as U
from ..functions.dates import hint_matches, parse_iso, ranked_evidence
from ..functions.text import any_of, bind, first_nonempty, text
from ..operators import acceptance as A
from ..operators import discovery as D
from ..operators import ranking as R
from ..operators import sinks
from ..operators import summary as S
from .persist import written


@dataclass
class Result:
    articles: DataFrame
    briefs: DataFrame
    created: DataFrame
    duplicates: DataFrame
    digest: DataFrame


def extract(pages: DataFrame, cfg: Config, keep: tuple[str, ...] = ()) -> DataFrame:
    """Articles of pages (url, html, and candidate hints and the source's selectors and least length of a body if there are any); keep: more columns of pages that stay."""
    for c in ("title_hint", "published_hint", "snippet_hint", "fetch_method"):
        if c not in pages.columns:
            pages = pages.withColumn(c, F.lit("table" if c == "fetch_method" else ""))
    least = F.col("min_body_chars") if "min_body_chars" in pages.columns else F.lit(cfg.min_body_chars)
    if "body_steps" not in pages.columns:
        pages = pages.withColumn("article_body_selectors", F.array(*map(F.lit, N.PROFILE_BODY))).withColumn("body_steps", N.compiled("article_body_selectors"))
    rows = pages.withColumn("ld", H.jsonld_fields(H.jsonld_blocks("html"))).withColumn("ld_dates", H.jsonld_dates(H.jsonld_blocks("html"))).withColumn("metrics", H.narrative_metrics("html")).withColumn("dom", N.tree("html"))
    body = N.article_body(F.col("dom"), F.col("ld.body"), F.col("article_body_selectors"), F.col("body_steps"), least, mode=cfg.merge_mode)
    dates = N.page_evidence(F.col("dom"), F.col("ld_dates"), F.col("published_hint"), F.coalesce(F.date_format(U.url_date("url"), "yyyy-MM-dd"), F.lit("")))
    rows = bind(rows, title=first_nonempty(F.col("ld.title"), H.meta_content("html", "og:title", "twitter:title", "headline"), N.heading(F.col("dom")), H.title_tag("html"), "title_hint"), described=H.meta_content("html", "description", "og:description"), body=body, dates=dates, visible=H.visible_text("html"))
    published = first_nonempty(F.col("ld.published"), H.meta_content("html", "article:published_time", "datePublished", "pubdate", "date", "dc.date"))
    rows = bind(rows.withColumn("body_text", F.col("body.text")), author=first_nonempty(F.col("ld.author"), H.meta_content("html", "author", "article:author")), published_at=parse_iso(published), evidence=ranked_evidence(F.col("dates"), cfg.target_date, cfg.run_date, F.col("visible")), scope=L.scope("title", "body_text", cfg.lexicon), score=L.relevance("title", "body_text", cfg.lexicon))
    return rows.select(
        F.col("url").alias("source_url"), "title", "author", "published_at", "body_text", "scope", "fetch_method", F.col("body.method").alias("extraction_method"), F.col("published_hint").alias("discovery_published_hint"), F.col("snippet_hint").alias("discovery_snippet"), F.col("title_hint").alias("discovery_title"), "score", "evidence", "metrics", "visible", "described", *keep,
    )


def verified(articles: DataFrame, cfg: Config) -> DataFrame:
    """Articles beside their source with the verification, and what it changes."""
    v = A.verification("title", "body_text", F.col("source_url"), F.col("evidence"), F.col("metrics"), cfg, F.col("source_role"), ("discovery_snippet", "described", "visible", "discovery_title"))
    rows = bind(articles, verification=v).drop("evidence", "metrics", "visible", "described", "discovery_title")
    found = F.col("verification")
    published = F.when((found["published_at"] != "") & ((F.col("published_at") == "") | found["has_valid_same_day_date"]), found["published_at"]).otherwise(F.col("published_at"))
    rows = bind(rows, published_at=published, scope=F.when(F.col("scope") == "Unknown", L.scope_of_targets(found["verified_metals"], F.col("scope"))).otherwise(F.col("scope")))
    notes = [("page_type", "page_type"), ("narrative_chars", "narrative_chars"), ("quote_signal", "quote_signal"), ("verification_confidence", "confidence")]
    return rows.withColumn("warnings", F.concat(F.array(*[F.concat(F.lit(f"{k}:"), found[c].cast("string")) for k, c in notes]), F.array(F.concat(F.lit("verified_metals:"), F.array_join(found["verified_metals"], ",")))))


with_source = D.with_source


def one_of_each(pages: DataFrame) -> DataFrame:
    """Of several copies of a page the longest, of equals the one of the greater hash, whatever their order."""
    return R.best_by(pages, ["url"], [F.length("html"), F.xxhash64("html"), F.xxhash64(*pages.columns)])


def judge(pages: DataFrame, sources: DataFrame, cfg: Config, keep: tuple[str, ...] = ()) -> DataFrame:
    """Articles of pages with verification, acceptance and relevance. Pages that name their source (source_name among keep) go by it, others by host."""
    own = pages.join(sources, "source_name") if "source_name" in keep else with_source(one_of_each(pages), sources, "url")
    rows = verified(extract(own, cfg, tuple(dict.fromkeys((*keep, *sources.columns)))), cfg)
    return bind(rows, acceptance=A.acceptance(cfg), relevance=A.relevance_rule(cfg))


def publishable(judged: DataFrame, cfg: Config, scope: str) -> DataFrame:
    """Of judged articles the accepted ones: the best of each url, gated and in scope."""
    rows = judged.where("acceptance.accepted").withColumn("score", F.col("acceptance.score")).withColumn("norm_url", U.normalize_url("source_url"))
    rows = R.top_per(rows, ["norm_url"], [F.col("score").desc(), F.col("source_url"), F.col("source_name")], 1, "ord").drop("ord")
    gate = F.col("relevance.should_summarize")
    return rows.where(F.coalesce(gate, F.lit(cfg.on_error == "keep"))).where(L.scope_matches(F.lit(scope), "scope"))


def capped(rows: DataFrame, cfg: Config) -> DataFrame:
    """Capped by source, in order. The cap counts only what may be published."""
    return R.final_order(R.top_per(rows, ["source_name"], [F.col("score").desc(), F.col("source_url")], cfg.per_source_limit * cfg.headroom, "ord"), cfg.max_articles_total)


def articles(pages: DataFrame, sources: DataFrame, cfg: Config, scope: str = "All") -> DataFrame:
    """Accepted articles of fetched pages."""
    return capped(publishable(judge(pages, sources, cfg), cfg, scope), cfg)


def kept_signal(cfg: Config):
    """A reason to keep an outside candidate: a target, a priority term, a hint of the day or the day in its url."""
    told = F.lower(F.concat_ws("\n", text("title_hint"), text("snippet_hint"), text("url")))
    return L.has_target(told, cfg.lexicon) | any_of(told, cfg.lexicon.priority) | hint_matches("published_hint", cfg.target_date, cfg.run_date) | U.same_day_url("url", cfg.target_date)


def short_listed(stages: dict[str, DataFrame], sources: DataFrame, cfg: Config, outside: DataFrame | None = None, search: DataFrame | None = None) -> DataFrame:
    """The short list of each source: what the stages found, merged by url. search and outside (with source_name) are asked only for sources the stages leave short."""
    found = written(D.discover(stages, sources, cfg, outside, search), "candidates")
    listed, points = A.shortlist_score(cfg)
    rows = bind(found.withColumn("is_pdf", U.looks_like_pdf("url")).withColumn("is_report", U.looks_like_report("url")), listed=listed, points=points).where("listed")
    cap = cfg.max_candidates // 2
    more = int(cfg.max_candidates * cfg.outside_cap_ratio)
    quota = R.Outside(F.col("stage") == "external", kept_signal(cfg), more, max(15, more), cfg.outside_floor) if outside is not None else None
    return R.shortlist(rows, F.col("points"), cap, max(18, cap), cfg.shortlist_threshold, cfg.backfill_threshold, quota)


def candidates(stages: dict[str, DataFrame], sources: DataFrame, cfg: Config, outside: DataFrame | None = None, search: DataFrame | None = None) -> DataFrame:
    """What is worth fetching, in order (candidate_rank) of each source: of the short list what the fast filter passes, which keeps a floor of its best rejects."""
    short = short_listed(stages, sources, cfg, outside, search)
    judged = bind(short, prefilter=A.fast_prefilter(cfg))
    ranked = judged.withColumn("accepted", F.col("prefilter.accepted")).withColumn("score", F.col("prefilter.score")).withColumn("candidate_rank", F.col("list_rank"))
    return R.prefilter_floor(ranked, cfg.prefilter_floor)


def fetched(wanted: DataFrame, pages: DataFrame) -> DataFrame:
    """Candidates beside their pages (url, html); of several copies of a page the longest."""
    own = R.best_by(pages.select(U.normalize_url("url").alias("norm_url"), F.col("url").alias("page_url"), "html"), ["norm_url"], [F.length("html"), F.xxhash64("html"), F.col("page_url")])
    found = wanted.withColumn("norm_url", U.normalize_url("url")).drop("url").join(own, "norm_url")
    return found.select(F.col("page_url").alias("url"), "html", "title_hint", "published_hint", "snippet_hint", "source_name", "candidate_rank", "is_pdf")


def collect(stages: dict[str, DataFrame], pages: DataFrame, sources: DataFrame, cfg: Config, scope: str = "All", outside: DataFrame | None = None, attempts: int | None = None, search: DataFrame | None = None) -> DataFrame:
    """The whole way: candidates, their pages, HTML before PDF, the first accepted ones of each source among its first attempts, publishable and capped."""
    wanted = written(fetched(candidates(stages, sources, cfg, outside, search), pages), "fetched")
    tried = judge(wanted, sources, cfg, ("source_name", "candidate_rank", "is_pdf")).withColumn("accepted", F.col("acceptance.accepted"))
    # The short list has bounded each source's rows.
    first = R.html_first(tried, cfg.per_source_limit, bounded=True)
    taken = R.capped_accepted(first, cfg.per_source_limit * cfg.headroom, attempts or cfg.max_candidates)
    return capped(publishable(taken, cfg, scope), cfg)


def briefs(rows: DataFrame, cfg: Config, run_id: str, generated_at: str, lists=S.EVIDENCE) -> DataFrame:
    ready = bind(rows, summary=S.rule_summary("title", "body_text", lists)).withColumn("mode", F.lit("rule"))
    return S.brief_rows(ready, run_id, generated_at, cfg)


def run(pages: DataFrame, sources: DataFrame, existing: DataFrame, cfg: Config, run_id: str, scope: str = "All", selected: DataFrame | None = None, fallback: DataFrame | None = None, alert_mode: str = "created_only", stages: dict[str, DataFrame] | None = None) -> Result:
    """Articles of the selected sources; where they give none, those of the fallback. existing: UniqueKey of the sink. With stages the run
    begins with discovery, else with fetched pages."""
    of = lambda chosen: articles(pages, chosen, cfg, scope) if stages is None else collect(stages, pages, chosen, cfg, scope)
    found = written(of(selected if selected is not None else sources), "articles")
    if fallback is not None and found.isEmpty():
        found = written(of(D.fallback_sources(sources, selected if selected is not None else sources.limit(0), fallback)), "articles")
    rows = written(briefs(found, cfg, run_id, cfg.run_date).withColumn("ord", F.xxhash64("UniqueKey", "SourceUrl")), "briefs")
    created, again = sinks.new_rows(rows, existing), sinks.duplicate_rows(rows, existing)
    return Result(found, rows, created, again, S.digest_groups(sinks.alert_rows(created, again, rows, alert_mode)))
