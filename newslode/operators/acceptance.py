"""Predicates over candidates, pages and articles: accept, prefilter, verify, judge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from ..config import Config
from ..functions import html as H
from ..functions import lexicon as L
from ..functions import url as U
from ..functions.dates import article_same_day, candidate_same_day, days_from, hint_matches, parse_iso, relative_hint
from ..functions.text import any_of, as_col, let, merge_blocks, normalize_space, text

EMPTY = lambda: F.array().cast("array<string>")


def hits(blob: Column, terms: Column) -> Column:
    return F.exists(F.coalesce(terms, EMPTY()), lambda t: F.contains(blob, F.lower(t)))


def role_of(role) -> Column:
    low = F.lower(normalize_space(role))
    return F.when(low.isin("narrative_news", "market_data", "market_research"), low).otherwise("narrative_news")


def min_body_chars(default: Column | int, floor: int = 35) -> Column:
    return F.greatest(F.lit(default) if isinstance(default, int) else default, F.lit(floor))


def source_accepts(url, cfg: Config, s: str = "") -> Column:
    """By the source's columns (prefix s): host, PDF rule, article shape, exclusions, report terms, hints."""
    norm = U.normalize_url(url)
    low, pdf = F.lower(norm), U.looks_like_pdf(norm)
    keywords = L.discovery_keywords(s, cfg.lexicon)
    hinted = (F.size(F.col(f"{s}include_hints")) == 0) | hits(low, F.col(f"{s}include_hints")) | (L.candidate_score(F.lit(""), norm, F.lit(""), cfg, keywords) >= 2) | U.looks_like_report(norm)
    report = U.looks_like_report(norm) | hits(low, F.col(f"{s}report_terms"))
    return U.allowed_host(norm, F.col(f"{s}allowed_hosts")) & ~hits(low, F.col(f"{s}exclude_hints")) & F.when(pdf, F.col(f"{s}pdf_report_ok") & report).otherwise(U.looks_like_article(norm) & hinted)


def source_accepts_legacy(url, s: str = "") -> Column:
    """The older rule: hints are hard."""
    low = F.lower(U.normalize_url(url))
    return U.allowed_host(url, F.col(f"{s}allowed_hosts")) & U.looks_like_article(url) & ~hits(low, F.col(f"{s}exclude_hints")) & ((F.size(F.col(f"{s}include_hints")) == 0) | hits(low, F.col(f"{s}include_hints")))


def soft_accepts(url, cfg: Config, s: str = "") -> Column:
    low, keywords = F.lower(U.normalize_url(url)), L.discovery_keywords(s, cfg.lexicon)
    pdf = F.col(f"{s}pdf_report_ok") & (U.looks_like_report(url) | hits(low, F.col(f"{s}report_terms")))
    ok = source_accepts(url, cfg, s) | F.when(U.looks_like_pdf(url), pdf).otherwise(hits(low, keywords) | (L.candidate_score(F.lit(""), url, F.lit(""), cfg, keywords) >= 1))
    return U.allowed_host(url, F.col(f"{s}allowed_hosts")) & ~hits(low, F.col(f"{s}exclude_hints")) & ok


def traversal_score(url, anchor, cfg: Config, keywords: Column, include: Column, accepted: Column) -> Column:
    """How much a link is worth following; one that is itself accepted as an article needs no following."""
    blob = F.lower(F.concat_ws(" ", text(anchor), text(url)))
    w = lambda c, n: F.when(c, n).otherwise(0)
    return (
        w(U.pagination_link(url, anchor), 6) + w(U.section_page(url), 4) + w(U.same_day_url(url, cfg.target_date), 4) + w(L.has_target(blob, cfg.lexicon), 3) + w(hits(blob, keywords), 3)
        + w(hits(blob, include), 2) + w(any_of(blob, ("news", "analysis", "market", "report")), 2) - w(accepted, 4) - w(U.non_content(url), 10)
    )


def follow(url, anchor, cfg: Config, keywords: Column, s: str = "") -> Column:
    low = F.lower(text(url))
    return U.allowed_or_seed_host(url, F.col(f"{s}allowed_hosts"), F.col(f"{s}seed_urls")) & ~U.looks_like_pdf(url) & ~U.non_content(url) & (~hits(low, F.col(f"{s}exclude_hints")) | U.pagination_link(url, anchor)) & (traversal_score(url, anchor, cfg, keywords, F.col(f"{s}include_hints"), source_accepts(url, cfg, s)) >= 4)


def anchor_candidate_score(url, anchor, snippet, cfg: Config, keywords: Column | None = None) -> Column:
    """Of a link on a listing: two more for a target, three for the day, four less for a page turn."""
    blob = F.concat_ws(" ", text(anchor), text(snippet), text(url))
    return L.candidate_score(anchor, url, snippet, cfg, keywords) + F.when(L.has_target(blob, cfg.lexicon), 2).otherwise(0) + F.when(U.same_day_url(url, cfg.target_date), 3).otherwise(0) - F.when(U.pagination_link(url, anchor), 4).otherwise(0)


def fast_prefilter(cfg: Config, s: str = "") -> Column:
    """struct(accepted, score, reasons) of a candidate (url, title_hint, snippet_hint, published_hint, method, score) beside its source."""
    return let(merge_blocks("title_hint", "snippet_hint", "url", most=2500, mode=cfg.merge_mode), lambda blob: let(_prefilter_signals(blob, cfg, s), lambda x: _prefilter(x, cfg, s)))


def _prefilter_signals(blob: Column, cfg: Config, s: str) -> Column:
    lex, url, low = cfg.lexicon, F.col("url"), F.lower(blob)
    metal, market = L.has_target(blob, lex), L.market_context(blob, lex) | any_of(low, lex.priority)
    day, relative = candidate_same_day("published_hint", "url", cfg.target_date, cfg.run_date), relative_hint("published_hint")
    report = U.looks_like_report(url) | hits(low, F.col(f"{s}report_terms"))
    outside = F.startswith(text("method"), F.lit("external"))
    flags = {"metal": metal, "market": market, "day": day, "relative": relative, "report": report, "outside": outside, "old": U.old_archive(url, cfg.target_date), "section": U.section_page(url)}
    return F.struct(*[c.alias(n) for n, c in flags.items()])


def _prefilter(x: Column, cfg: Config, s: str) -> Column:
    role = role_of(F.col(f"{s}source_role"))
    metal, market, day, relative, report, outside, old = (x[c] for c in ("metal", "market", "day", "relative", "report", "outside", "old"))
    section = x["section"] & ~day & ~relative
    w = lambda c, n: F.when(c, n).otherwise(0)
    score = F.col("score") + w(metal, 5) + w(market, 3) + F.when(day, 5).when(relative, 4).otherwise(0) + w(outside, 2) + w(report, 2)
    named = lambda *cs: F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in cs]))
    good = named((metal, "metal_signal"), (market, "market_signal"), (day, "date_signal"), (relative & ~day, "relative_same_day_signal"), (outside, "external_candidate"), (report, "report_signal"))
    by_role = F.when(role == "narrative_news", (metal & (day | relative | market)) | (day & market)).when(role == "market_data", metal | day | relative).otherwise(metal & (report | market | day))
    rescue = ~by_role & outside & (score >= 7)
    bad = named((~metal, "missing_metal_signal"), (~day & ~relative, "missing_same_day_hint"), (~market & (role != "market_data"), "missing_market_hint"))
    done = lambda ok, points, why: F.struct(ok.alias("accepted"), points.cast("int").alias("score"), why.alias("reasons"))
    return (
        F.when(old, done(F.lit(False), F.col("score") - 20, F.array(F.lit("old_archive_url"))))
        .when(section, done(F.lit(False), F.col("score") - 10, F.array(F.lit("section_like_url"))))
        .when(by_role, done(F.lit(True), score, good))
        .when(rescue, done(F.lit(True), score, F.concat(good, F.array(F.lit("external_rescue")))))
        .otherwise(done(F.lit(False), score, bad))
    )


def shortlist_score(cfg: Config) -> tuple[Column, Column]:
    """(may be listed, score) of a candidate for the shortlist."""
    lex = cfg.lexicon
    blob = F.concat_ws("\n", text("title_hint"), text("snippet_hint"), text("url"))
    low = F.lower(blob)
    target, priority = L.has_target(blob, lex), any_of(low, lex.priority)
    day_url = U.same_day_url("url", cfg.target_date)
    relative = any_of(F.lower(normalize_space("published_hint")), [t for t in C.RELATIVE_DAYS if t != "just now"])
    outside = F.startswith(text("method"), F.lit("external"))
    w = lambda c, n: F.when(c, n).otherwise(0)
    listed = ~U.old_archive("url", cfg.target_date) & ~(any_of(low, lex.company) & ~priority & ~day_url) & (target | any_of(low, lex.structure) | priority | relative | day_url | outside)
    exact = F.substring(parse_iso("published_hint"), 1, 10) == cfg.target_date
    kept_old = any_of(U.host_of("url"), C.OLD_PAGE_HOSTS) & ~day_url
    score = (
        F.col("score") - w(U.section_page("url"), 10) + F.when(target, 7).otherwise(-cfg.shortlist_non_target_penalty) + L.contains_sum(low, lex.priority, 3)
        + F.when(exact, 9).when(hint_matches("published_hint", cfg.target_date, cfg.run_date), 8).otherwise(0) + w(day_url, 10) - w(F.contains(F.lower(text("url")), F.lit("/archive/")), 8) - w(kept_old, 8)
        + w(target & priority, 7) + w(F.col("method").isin(*C.DYNAMIC_METHODS), 1) + w(outside, 3)
        + F.when(U.looks_like_pdf("url"), -cfg.shortlist_pdf_penalty).otherwise(cfg.shortlist_html_bonus + w(U.looks_like_report("url"), 1))
    )
    return listed, score


def page_type(title, body, url, cfg: Config, metrics: Column, quote: Column, role: Column | None = None) -> Column:
    """The first of eleven labels that fits."""
    low_url, t = F.lower(U.normalize_url(url)), F.lower(normalize_space(title))
    return let(F.lower(F.concat_ws(" ", text(title), text(body), text(url))), lambda x: _page_label(x, t, low_url, url, cfg, metrics, quote, role))


def _page_label(x: Column, t: Column, low_url: Column, url, cfg: Config, metrics: Column, quote: Column, role: Column | None) -> Column:
    labels = F.regexp_count(x, F.lit(r"\b(?:lme|lmeselect|shfe|comex|cash|3m|bid|ask|open|high|low|volume|change|settlement|contract|warehouse|symbol|ticker)\b"))
    contracts = F.regexp_count(x, F.lit(r"\b[a-z]{1,3}\d{1,4}\b"))
    chars, density, signal = metrics["narrative_chars"], metrics["table_density"], quote["signal"]
    told = chars >= cfg.narrative_chars
    table = ~told | (metrics["narrative_paragraphs"] < cfg.narrative_paragraphs) | (density >= 0.32)
    data = any_of(x, ("price", "market data", "inventory", "stocks", "warehouse", "premium", "spread", "settlement", "open interest", "futures", "cash"))
    data = data if role is None else data | (role == "market_data")
    return (
        F.when(any_of(low_url, ("/archive/", "/archives/")), "archive_page")
        .when(any_of(low_url, ("/category/", "/tag/", "/tags/", "/author/", "/authors/")) | U.section_page(url), "category_page")
        .when(F.contains(low_url, F.lit("/symbol/")) | (F.contains(t, F.lit("symbol")) & table & (labels >= 6)), "symbol_landing_page")
        .when(F.contains(low_url, F.lit("/ticker/")) | (table & (labels >= 10) & any_of(low_url, ("/quote/", "/quotes/", "/price/", "/prices/"))), "ticker_page")
        .when(any_of(low_url, ("/future/", "/futures/")) & ((signal != "low") | table | (contracts >= 3) | (labels >= 8)), "futures_table_page")
        .when(any_of(low_url, ("/prices/", "/price/", "/quote/", "/quotes/", "/spot/")) & ((signal != "low") | table), "quote_page")
        .when((signal == "high") & (table | (contracts >= 3) | (labels >= 8)), "quote_page")
        .when(U.looks_like_report(url) | any_of(x, ("report", "research", "outlook", "forecast")), "report")
        .when(any_of(x, ("analysis", "commentary", "insight", "review")) & told, "analyst_article")
        .when(L.market_context(x, cfg.lexicon) & told, "market_news")
        .when(data & ((signal != "low") | (density >= cfg.data_table_density) | (labels >= 6) | ~told), "market_data_page")
        .otherwise("unknown")
    )


def override_allowed(v: Column, cfg: Config) -> Column:
    """A page of an excluded type that tells enough all the same. v: struct or row of the verification's columns."""
    return v["page_type"].isin(*C.EXCLUDED_PAGES) & v["has_target_metal"] & v["has_market_context"] & v["has_valid_same_day_date"] & (v["narrative_chars"] >= cfg.override_chars) & (v["narrative_paragraphs"] >= cfg.override_paragraphs) & (v["table_density"] <= cfg.override_density)


def override_allowed_for_article(v: Column, cfg: Config) -> Column:
    return v["page_type"].isin(*C.EXCLUDED_PAGES) & v["has_target_metal"] & v["has_market_context"] & v["has_valid_same_day_date"] & (v["narrative_chars"] >= cfg.override_chars) & (v["quote_signal"] != "high")


def structure_accepted(v: Column, cfg: Config) -> Column:
    over = override_allowed(v, cfg)
    return (v["narrative_chars"] >= cfg.narrative_chars) & (v["narrative_paragraphs"] >= cfg.narrative_paragraphs) & (~v["page_type"].isin(*C.EXCLUDED_PAGES) | over) & ((v["quote_signal"] != "high") | over)


def data_allowed(v: Column, cfg: Config) -> Column:
    return v["page_type"].isin("analyst_article", "market_news", "report") & (v["narrative_chars"] >= cfg.data_chars) & (v["narrative_paragraphs"] >= cfg.data_paragraphs) & (v["quote_signal"] == "low") & (v["table_density"] <= cfg.data_density)


def research_allowed(v: Column, cfg: Config, reportish: Column) -> Column:
    return (v["page_type"].isin("analyst_article", "market_news", "report") | reportish) & (v["narrative_chars"] >= cfg.research_chars) & (v["narrative_paragraphs"] >= cfg.narrative_paragraphs)


def verification(title, body, url, evidence: Column, metrics: Column, cfg: Config, role: Column | None = None, context: tuple = ()) -> Column:
    """struct of what a page shows: targets, context, date, type, reject reasons, score, confidence.

    evidence: dates.date_evidence; metrics: html.narrative_metrics; context: more texts of the page and of what led to it.
    """
    lex = cfg.lexicon
    blob = merge_blocks(title, body, *context, url, most=None, mode=cfg.merge_mode)
    day = evidence["same_day"] | (F.substring(evidence["published_at"], 1, 10) == cfg.target_date)
    shown = lambda b: F.struct(L.mentions(b, lex).alias("found"), L.market_context(b, lex).alias("context"), H.quote_signal(title, body, url).alias("quote"))
    base = lambda x: F.struct(
        (F.size(x["found"]) > 0).alias("has_target_metal"), x["found"].alias("verified_metals"), x["context"].alias("has_market_context"), day.alias("has_valid_same_day_date"), evidence["published_at"].alias("published_at"), evidence["same_day"].alias("same_day_hint"), evidence["checked"].alias("date_sources_checked"),
        page_type(title, body, url, cfg, metrics, x["quote"], role).alias("page_type"), metrics["narrative_chars"].alias("narrative_chars"), metrics["narrative_paragraphs"].alias("narrative_paragraphs"), metrics["table_density"].alias("table_density"), x["quote"]["signal"].alias("quote_signal"), x["quote"]["reasons"].alias("quote_reasons"),
    )

    def judged(v: Column) -> Column:
        over = override_allowed(v, cfg)
        reasons = [
            (~v["has_target_metal"], F.lit("missing_target_metal_after_page_check")), (~v["has_market_context"], F.lit("missing_market_context_after_page_check")),
            (~v["has_valid_same_day_date"] & (v["published_at"] != ""), F.lit("date_mismatch_after_full_page_check")), (~v["has_valid_same_day_date"] & (v["published_at"] == ""), F.lit("missing_date_after_full_page_check")),
            (v["page_type"].isin(*C.EXCLUDED_PAGES) & ~over, F.concat(F.lit("page_type_"), v["page_type"])), ((v["narrative_chars"] < cfg.narrative_chars) | (v["narrative_paragraphs"] < cfg.narrative_paragraphs), F.lit("insufficient_narrative_body")),
            ((v["quote_signal"] == "high") & ~over, F.lit("quote_signal_high")),
        ]
        why = F.concat(F.array_compact(F.array(*[F.when(c, n) for c, n in reasons])), F.transform(F.slice(v["quote_reasons"], 1, 5), lambda r: F.concat(F.lit("quote_reason:"), r)))
        score = F.when(v["has_target_metal"], 4).otherwise(0) + F.when(v["has_market_context"], 3).otherwise(0) + F.when(v["has_valid_same_day_date"], 4).otherwise(0) + F.when(over, 1).otherwise(0)
        kept = [v[c].alias(c) for c in ("has_target_metal", "verified_metals", "has_market_context", "has_valid_same_day_date", "published_at", "same_day_hint", "date_sources_checked", "page_type", "narrative_chars", "narrative_paragraphs", "table_density", "quote_signal")]
        return F.struct(*kept, F.array_distinct(why).alias("reject_reasons"), score.alias("score"), F.when(score >= 10, "high").when(score >= 6, "medium").otherwise("low").alias("confidence"))

    return let(let(let(blob, shown), base), judged)


def acceptance(cfg: Config, s: str = "") -> Column:
    """struct(accepted, score, reasons, reject_reasons) of an article (title, body_text, discovery_snippet, discovery_published_hint,
    published_at, scope, source_url, extraction_method, fetch_method, verification) beside its source."""
    lex, role = cfg.lexicon, role_of(F.col(f"{s}source_role"))
    blob = F.lower(F.concat_ws("\n", text("title"), text("body_text"), text("discovery_snippet")))
    head = F.concat_ws("\n", text("title"), text("discovery_snippet"))
    fast, listed, n = L.relevance("title", "body_text", lex), L.relevance("title", "discovery_snippet", lex), F.length(text("body_text"))
    pdf = F.startswith(text("extraction_method"), F.lit("pdf:"))
    v = F.col("verification")
    report = pdf | U.looks_like_report("source_url") | any_of(blob, ("report", "research", "forecast", "outlook", "analysis", "insight"))
    day = v["has_valid_same_day_date"]
    published = F.when((v["published_at"] != "") & ((text("published_at") == "") | day), v["published_at"]).otherwise(text("published_at"))
    hint = hint_matches("discovery_published_hint", cfg.target_date, cfg.run_date)
    exact = (published != "") & (days_from(published, cfg.target_date) == 0)
    known = F.struct(fast.alias("fast"), listed.alias("listed"), n.alias("n"), pdf.alias("pdf"), report.alias("reportish"), published.alias("published"), hint.alias("hint"), exact.alias("exact"), L.market_context(head, lex).alias("head"), L.topic_matches("title", "discovery_snippet", "body_text", "discovery_published_hint", "scope", cfg).alias("topic"), L.content_matches("title", "body_text", "discovery_snippet", "extraction_method", cfg).alias("content"))
    return let(known, lambda k: _judge(k, v, role, cfg, s))


def _judge(k: Column, v: Column, role: Column, cfg: Config, s: str) -> Column:
    fast, listed, n, pdf, reportish, published, hint, exact = (k[c] for c in ("fast", "listed", "n", "pdf", "reportish", "published", "hint", "exact"))
    metal, context, day = v["has_target_metal"], v["has_market_context"], v["has_valid_same_day_date"]
    # Each cascade: (condition, points, reason, reject reason).
    topic = [(~metal & (fast < 2), 0, None, "weak_topic"), (metal & context, 5, "page_verified", None), (k["topic"], 4, "topic_match", None), (fast >= cfg.topic_threshold, 2, "topic_relaxed", None), (listed >= cfg.topic_threshold, 2, "listing_context_match", None)]
    primary = [(F.size(v["verified_metals"]) > 0, 2, "primary_metals", None)]
    body = [(n >= F.col(f"{s}min_body_chars"), 2, "body_ok", None), (F.col(f"{s}paywalled_preview_ok") & (n >= cfg.preview_chars), 1, "paywall_preview_ok", None), (reportish & (n >= cfg.report_chars), 1, "report_body_ok", None), (k["head"], 1, "title_snippet_rescue", None), (fast < cfg.short_body_score, 0, None, "body_too_short")]
    content = [(context, 3, "verified_market_context", None), (k["content"], 3, "content_match", None), (reportish, 2, "reportish", None), ((n >= cfg.longform_chars) & (fast >= cfg.longform_score), 1, "longform_rescue", None), (F.lit(True), -1, None, "weak_content_type")]
    date = [(day, 3, "verified_target_date", None), (exact, 3, "target_date_exact", None), (hint, 2, "date_hint_match", None), (published != "", 0, None, "date_mismatch"), (F.lit(True), 0, None, "missing_date")]
    known = [(F.col("scope") != "Unknown", 1, "scope_known", None)]
    last = [(pdf, -1, "pdf_last_resort", None)]
    rendered = [(F.col("fetch_method") == "rendered", 1, "rendered", None)]
    upgrade = data_allowed(v, cfg) | override_allowed(v, cfg)
    fit = [
        ((role == "narrative_news") & v["page_type"].isin("analyst_article", "market_news"), 1, "narrative_source_fit", None), ((role == "market_data") & upgrade, 1, "market_data_narrative_upgrade", None), ((role == "market_data") & ~upgrade, 0, None, "market_data_reference_only"),
        ((role == "market_research") & research_allowed(v, cfg, reportish), 1, "market_research_context", None), (role == "market_research", 0, None, "market_research_background_only"),
    ]

    def first(rules, pick, none) -> Column:
        out = none
        for rule in reversed(rules):
            out = F.when(F.coalesce(rule[0], F.lit(False)), pick(rule)).otherwise(out)
        return out

    groups = [topic, primary, body, content, date, known, last, rendered, fit]
    score = sum((first(g, lambda r: F.lit(r[1]), F.lit(0)) for g in groups), F.lit(0))
    null = F.lit(None).cast("string")
    reasons = F.array_compact(F.array(*[first(g, lambda r: F.lit(r[2]).cast("string"), null) for g in groups]))
    rejects = F.concat(v["reject_reasons"], F.array_compact(F.array(*[first(g, lambda r: F.lit(r[3]).cast("string"), null) for g in groups])))
    hard = lambda rs: F.exists(rs, lambda r: r.isin(*C.HARD_REJECTS))
    told = F.struct(score.alias("score"), reasons.alias("reasons"), rejects.alias("rejects"))
    return let(told, lambda x: F.struct((metal & context & (day | exact | hint) & ~hard(x["rejects"]) & (x["score"] >= cfg.accept_score)).alias("accepted"), x["score"].alias("score"), x["reasons"].alias("reasons"), x["rejects"].alias("reject_reasons")))


def relevance_rule(cfg: Config) -> Column:
    """struct: is_relevant, should_summarize, target_metals, same_day_valid, market_context, page_type, scope, reason."""
    v = F.col("verification")
    targets = L.canonical_targets(v["verified_metals"])
    structure = ~v["page_type"].isin(*C.EXCLUDED_PAGES) | override_allowed_for_article(v, cfg)
    has, thin, quoted = F.size(targets) > 0, v["narrative_chars"] < cfg.narrative_chars, v["quote_signal"] == "high"
    relevant = has & v["has_market_context"]
    why = [(has, F.lit("target_metals_verified")), (v["has_valid_same_day_date"], F.lit("same_day_verified")), (v["has_market_context"], F.lit("market_context_verified")), (~structure, F.concat(F.lit("page_type_rejected:"), v["page_type"])), (thin, F.lit("narrative_too_thin")), (quoted, F.lit("quote_signal_high"))]
    reason = F.array_join(F.array_compact(F.array(*[F.when(c, n) for c, n in why])), ", ")
    return F.struct(
        relevant.alias("is_relevant"), (has & v["has_valid_same_day_date"] & v["has_market_context"] & structure & ~thin & ~quoted).alias("should_summarize"), targets.alias("target_metals"), v["has_valid_same_day_date"].alias("same_day_valid"), v["has_market_context"].alias("market_context"), v["page_type"].alias("page_type"),
        F.when(relevant, L.scope_of_targets(targets, "scope")).otherwise("Not Relevant").alias("scope"), F.when(reason == "", "rule_based_relevance").otherwise(reason).alias("reason"),
    )


def finalize_relevance(model: Column, cfg: Config) -> Column:
    """A model's answer (struct is_relevant, should_summarize, target_metals, same_day_valid, market_context, scope, reason; null for no say) beside what was verified.

    Either may vouch for the day and the context; a summary needs targets, day, context and a page of a fit type,
    whatever the model says; and what has them, or targets and context on a fit page, is relevant.
    """
    v = F.col("verification")
    said = lambda c: F.coalesce(model[c], F.lit(False))
    targets = L.canonical_targets(F.when(F.size(model["target_metals"]) > 0, model["target_metals"]).otherwise(v["verified_metals"]))
    day, context = said("same_day_valid") | v["has_valid_same_day_date"], said("market_context") | v["has_market_context"]
    fit = ~v["page_type"].isin(*C.EXCLUDED_PAGES)
    over = v["page_type"].isin(*C.EXCLUDED_PAGES) & (F.size(targets) > 0) & context & day & (v["narrative_chars"] >= cfg.override_chars) & (v["quote_signal"] != "high")
    known = F.struct(targets.alias("targets"), (F.size(targets) > 0).alias("has"), day.alias("day"), context.alias("context"), fit.alias("fit"), over.alias("over"))

    def told(k: Column) -> Column:
        summarize = said("should_summarize") & k["has"] & k["day"] & k["context"] & (k["fit"] | k["over"])
        relevant = said("is_relevant") | summarize | (k["has"] & k["context"] & k["fit"])
        scope = F.when(model["scope"].isin(*C.ALLOWED_SCOPES), model["scope"]).otherwise(L.scope_of_targets(k["targets"], "scope"))
        reason = F.coalesce(F.nullif(model["reason"], F.lit("")), F.when(summarize, "Structured relevance accepted").otherwise("Structured relevance rejected"))
        return F.struct(relevant.alias("is_relevant"), summarize.alias("should_summarize"), k["targets"].alias("target_metals"), k["day"].alias("same_day_valid"), k["context"].alias("market_context"), v["page_type"].alias("page_type"), scope.alias("scope"), reason.alias("reason"))

    return let(known, told)


def page_quality(status, html, body, title, kind: str, floor: int) -> Column:
    """Of a fetched page, for choosing between attempts."""
    status = as_col(status)
    base = F.when(status.between(200, 399), 4).when(status < 500, 1).otherwise(0) + F.when(text(title) != "", 3).otherwise(0)
    base = base + F.least(F.lit(4), F.floor(F.length(text(html)) / 1200)) + F.least(F.lit(4), F.floor(F.length(text(body)) / 600))
    if kind == "listing":
        base = base + F.least(F.lit(4), F.floor(F.regexp_count(F.lower(text(html)), F.lit("<a ")) / 8))
    else:
        base = base + F.when(F.length(text(body)) >= floor, 2).otherwise(0)
    return (base - F.when(H.block_page(html), 6).otherwise(0)).cast("int")


def weak_page(status, html, body, title, kind: str, floor: int) -> Column:
    n, links = F.length(text(html)), F.regexp_count(F.lower(text(html)), F.lit("<a "))
    thin = (n < 1200) | ((links < 5) & (F.length(text(body)) < 450)) if kind == "listing" else (text(title) == "") | (F.length(text(body)) < floor) | (n < 1500)
    return (as_col(status) >= 400) | (text(html) == "") | H.block_page(html) | thin


def should_render(status, html, body, title, kind: str, floor: int, allow: bool, js_heavy=False) -> Column:
    heavy = F.lit(js_heavy) if isinstance(js_heavy, bool) else js_heavy
    return F.lit(allow) & weak_page(status, html, body, title, kind, floor) & (heavy | F.lit(kind == "listing"))


def should_go_stealthy(status, html, body, title, kind: str, floor: int, allow: bool) -> Column:
    return F.lit(allow) & (as_col(status).isin(401, 403, 429) | H.block_page(html) | weak_page(status, html, body, title, kind, floor))


def should_render_article(v: Column, title, body, cfg: Config) -> Column:
    """A page without title, body or date is worth rendering."""
    return (normalize_space(title) == "") | (F.length(normalize_space(body)) < max(60, cfg.min_body_chars // 2)) | ~v["has_valid_same_day_date"]


def needs_local_fallback(v: Column, title, snippet, body, scope, cfg: Config) -> Column:
    head = F.concat_ws("\n", text(title), text(snippet))
    thin = (F.length(text(body)) < max(40, cfg.min_body_chars // 3)) & ~L.strong_signal(head, cfg.lexicon)
    vague = (as_col(scope) == "Unknown") & ~L.strong_signal(F.concat_ws("\n", head, text(body)), cfg.lexicon)
    return ~(v["has_target_metal"] & v["has_valid_same_day_date"] & v["has_market_context"]) & (thin | ~v["has_valid_same_day_date"] | ~v["has_target_metal"] | vague)


def external_gate(cfg: Config, s: str = "") -> Column:
    """An outside provider's candidate: host, archive, exclusions, shape, PDF rule and one sign of evidence."""
    blob = F.concat_ws(" ", text("title_hint"), text("snippet_hint"), text("url"))
    shape = F.when(U.looks_like_pdf("url"), F.col(f"{s}pdf_report_ok")).otherwise(U.looks_like_article("url"))
    sign = L.has_target(blob, cfg.lexicon) | L.market_context(blob, cfg.lexicon) | article_same_day(F.lit(""), "published_hint", cfg.target_date, cfg.run_date) | U.same_day_url("url", cfg.target_date) | U.looks_like_report("url")
    return U.allowed_host("url", F.col(f"{s}allowed_hosts")) & ~U.old_archive("url", cfg.target_date) & ~hits(F.lower(text("url")), F.col(f"{s}exclude_hints")) & shape & sign


def valid_address(x) -> Column:
    return F.contains(F.trim(text(x)), F.lit("@"))
