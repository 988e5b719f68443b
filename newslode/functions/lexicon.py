"""Scores and labels from word lists, all as plain column arithmetic."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from ..config import Config, Lexicon
from .dates import hint_matches
from .text import any_of, as_col, let, normalize_space, text
from .url import DATED, looks_like_article, looks_like_pdf, looks_like_report, old_archive, same_day_url, section_page


def contains_sum(x: Column, terms, points: int = 1, boundary: bool = False) -> Column:
    """points for each term that occurs; how often doesn't count."""
    out = F.lit(0)
    for t in terms:
        hit = F.regexp_like(x, F.lit(rf"\b{re.escape(t)}\b")) if boundary else F.contains(x, F.lit(t))
        out = out + F.when(hit, points).otherwise(0)
    return out


def symbol_in_context(x: Column, symbol: str, lexicon: Lexicon) -> Column:
    """The symbol stands alone and the text speaks of markets anywhere."""
    return F.regexp_like(x, F.lit(f"(?i)(?<![A-Za-z]){symbol}(?![A-Za-z])")) & any_of(F.lower(x), lexicon.symbol_context)


def mentions(x, lexicon: Lexicon) -> Column:
    """Targets named as words, or by symbol where the lexicon has symbols, in the lexicon's order."""
    return let(normalize_space(x), lambda clean: mentions_in(clean, lexicon))


def mentions_in(x: Column, lexicon: Lexicon) -> Column:
    found = []
    for name, words in lexicon.targets.items():
        hit = F.regexp_like(F.lower(x), F.lit("|".join(rf"\b{re.escape(w)}\b" for w in words)))
        if name in lexicon.symbols:
            hit = hit | symbol_in_context(x, lexicon.symbols[name], lexicon)
        found.append(F.when(hit, F.lit(name)))
    return F.array_compact(F.array(*found))


def has_target(x, lexicon: Lexicon) -> Column:
    return F.size(mentions(x, lexicon)) > 0


def market_context(x, lexicon: Lexicon) -> Column:
    return let(F.lower(normalize_space(x)), lambda low: any_of(low, lexicon.intelligence + lexicon.structure))


def strong_signal(x, lexicon: Lexicon) -> Column:
    return has_target(x, lexicon) & market_context(x, lexicon)


def keyword_bonus(title, url, keywords: Column) -> Column:
    """Two for a keyword of several words, one for a single word. keywords: array<string>."""
    blob = F.lower(F.concat_ws(" ", text(title), text(url)))
    low = F.transform(keywords, lambda k: F.lower(normalize_space(k)))
    return F.aggregate(F.filter(low, lambda k: (k != "") & F.contains(blob, k)), F.lit(0), lambda s, k: s + F.when(F.contains(k, F.lit(" ")), 2).otherwise(1))


def candidate_score(title, url, context, cfg: Config, keywords: Column | None = None) -> Column:
    lex = cfg.lexicon
    blob = F.lower(F.concat_ws(" ", text(title), text(context), text(url)))
    score = F.when(has_target(blob, lex), 6).otherwise(-cfg.non_target_penalty) + contains_sum(blob, lex.analysis, 2) + F.when(market_context(blob, lex), 2).otherwise(0) - contains_sum(blob, lex.negative, 5)
    if keywords is not None:
        score = score + keyword_bonus(F.concat_ws(" ", text(title), text(context)), url, keywords)
    score = score + F.when(F.length(normalize_space(context)) >= 80, 1).otherwise(0) + F.when(looks_like_report(url), 2).otherwise(0)
    score = score + F.when(looks_like_pdf(url), -cfg.pdf_score_penalty).otherwise(cfg.html_score_bonus)
    return score + F.when(F.regexp_like(text(url), F.lit(DATED)), 2).otherwise(0) - F.when(section_page(url), 6).otherwise(0)


def candidate_score_legacy(title, url, lexicon: Lexicon, pdf_bonus: int = 0) -> Column:
    """Older presets; pdf_bonus is 3 for reports in the later one."""
    blob = F.lower(F.concat_ws(" ", text(title), text(url)))
    score = contains_sum(blob, lexicon.direct, 4) + contains_sum(blob, lexicon.analysis, 2) - contains_sum(blob, lexicon.negative, 5)
    return score + F.when(looks_like_pdf(url) | looks_like_report(url), pdf_bonus).otherwise(0) + F.when(F.regexp_like(text(url), F.lit(DATED)), 2).otherwise(0)


def relevance(title, body, lexicon: Lexicon) -> Column:
    def points(t: Column, b: Column, both: Column) -> Column:
        return contains_sum(t, lexicon.primary, 5) + contains_sum(b, lexicon.primary, 3) + contains_sum(t, lexicon.broad, 3) + contains_sum(b, lexicon.broad, 2) + contains_sum(both, lexicon.analysis) - contains_sum(both, lexicon.negative, 5)

    t, b = F.lower(text(title)), F.lower(text(body))
    return let(F.struct(t.alias("t"), b.alias("b"), F.concat(t, F.lit("\n"), b).alias("both")), lambda x: points(x["t"], x["b"], x["both"]))


def relevance_legacy(title, body, lexicon: Lexicon) -> Column:
    t, b = F.lower(text(title)), F.lower(text(body))
    both = F.concat(t, F.lit("\n"), b)
    return contains_sum(t, lexicon.direct, 4) + contains_sum(b, lexicon.direct, 2) + contains_sum(both, lexicon.analysis) - contains_sum(both, lexicon.negative, 5)


def scope(title, body, lexicon: Lexicon, broad: tuple[str, ...] | None = None) -> Column:
    """Which targets the text names (as substrings): both, one, the broad group, or none. broad: another list, as in the older preset."""
    (a, wa), (b, wb) = list(lexicon.targets.items())[:2]
    la, lb = lexicon.labels[a], lexicon.labels[b]

    def named(blob: Column) -> Column:
        has_a, has_b = any_of(blob, wa), any_of(blob, wb)
        return F.when(has_a & has_b, f"{la}, {lb}").when(has_a, la).when(has_b, lb).when(any_of(blob, lexicon.broad if broad is None else broad), "Broad Metals").otherwise("Unknown")

    return let(F.lower(F.concat(text(title), F.lit("\n"), text(body))), named)


def normalize_scope(raw) -> Column:
    """An alias, with its separators made alike, to a scope; unknown is All."""
    key = F.lower(F.trim(F.regexp_replace(text(raw), r"\s*,\s*", ",")))
    out = F.lit("All")
    for alias, value in C.SCOPE_ALIASES.items():
        out = F.when(key == alias, value).otherwise(out)
    return out


def scope_matches(requested, found) -> Column:
    requested, found = as_col(requested), as_col(found)
    out = F.lit(True)
    for want, ok in C.SCOPE_LATTICE.items():
        out = F.when(requested == want, found.isin(*ok)).otherwise(out)
    return out


def scope_of_targets(names: Column, fallback) -> Column:
    a, b = F.array_contains(names, "copper"), F.array_contains(names, "aluminum")
    fallback = as_col(fallback)
    return F.when(a & b, "Copper, Aluminum").when(a, "Copper").when(b, "Aluminum").when(fallback.isin("Copper", "Aluminum", "Copper, Aluminum", "Broad Metals"), fallback).otherwise("Not Relevant")


def canonical_targets(values: Column) -> Column:
    low = F.transform(values, lambda v: F.lower(normalize_space(v)))
    named = F.transform(low, lambda v: F.when(v.isin("aluminium", "aluminum", "al"), "aluminum").when(v.isin("copper", "cu"), "copper"))
    return F.array_distinct(F.filter(named, lambda v: v.isNotNull()))


def topic_matches(title, snippet, body, hint, scope_col, cfg: Config) -> Column:
    lex = cfg.lexicon
    relative = any_of(F.lower(normalize_space(hint)), C.RELATIVE_DAYS)
    scoped = as_col(scope_col).isin("Copper", "Aluminum", "Copper, Aluminum")

    def joined(x: Column) -> Column:
        head = F.concat(x["t"], F.lit("\n"), x["s"])
        return F.struct(head.alias("head"), F.concat(head, F.lit("\n"), x["b"]).alias("whole"), relevance(x["t"], x["s"], lex).alias("head_score"), relevance(x["t"], F.concat(x["s"], F.lit("\n"), x["b"]), lex).alias("whole_score"))

    def signals(x: Column) -> Column:
        low = F.lower(x["whole"])
        return F.struct(market_context(x["head"], lex).alias("context_head"), market_context(x["whole"], lex).alias("context_all"), has_target(x["head"], lex).alias("target_head"), has_target(x["whole"], lex).alias("target_all"), any_of(low, lex.company).alias("company"), any_of(F.lower(x["head"]), lex.priority).alias("priority"), (x["head_score"] >= cfg.topic_threshold).alias("head_ok"), (x["whole_score"] >= 3).alias("all_ok"))

    def decide(f: Column) -> Column:
        strong = f["target_head"] & f["context_head"]
        yes = (strong & relative) | (f["context_head"] & f["head_ok"]) | (scoped & f["all_ok"]) | (f["context_all"] & f["all_ok"]) | (f["target_head"] & f["priority"] & f["head_ok"])
        return f["target_all"] & ~(f["company"] & ~(strong | f["context_all"])) & yes

    parts = F.struct(normalize_space(title).alias("t"), normalize_space(snippet).alias("s"), normalize_space(body).alias("b"))
    return let(parts, lambda x: let(joined(x), lambda y: let(signals(y), decide)))


def topic_matches_legacy(title, body, scope_col, lexicon: Lexicon) -> Column:
    score = relevance_legacy(title, body, lexicon)
    return F.when(as_col(scope_col).isin("Copper", "Aluminum", "Copper, Aluminum"), score >= 3).when(as_col(scope_col) == "Broad Metals", score >= 5).otherwise(False)


def content_matches(title, body, snippet, extraction, cfg: Config) -> Column:
    lex = cfg.lexicon
    blob = F.lower(F.concat(text(title), F.lit("\n"), text(body), F.lit("\n"), text(snippet)))
    long = (F.length(text(body)) >= cfg.rescue_body_chars) & (relevance(title, body, lex) >= cfg.rescue_score)
    return let(blob, lambda x: has_target(x, lex) & (market_context(x, lex) | F.startswith(text(extraction), F.lit("pdf:")) | long))


def content_matches_legacy(title, body, words=("news", "analysis", "review", "outlook", "commentary", "insight", "market")) -> Column:
    return any_of(F.lower(F.concat(text(title), F.lit("\n"), text(body))), words)


def stance(x, bull=C.STANCE_BULL, bear=C.STANCE_BEAR) -> Column:
    def of(low: Column) -> Column:
        counts = F.struct(contains_sum(low, bull).alias("up"), contains_sum(low, bear).alias("down"))
        return let(counts, lambda n: F.when(n["up"] > n["down"], "Bullish").when(n["down"] > n["up"], "Bearish").when(n["up"] > 0, "Mixed").otherwise("Neutral"))

    return let(F.lower(text(x)), of)


def theme(title, body, rules=C.THEMES, default: str = C.THEME_DEFAULT) -> Column:
    def of(low: Column) -> Column:
        out = F.lit(default)
        for terms, name in reversed(rules):
            out = F.when(any_of(low, terms), name).otherwise(out)
        return out

    return let(F.lower(F.concat_ws(" ", text(title), text(body))), of)


def digest_section(x, theme_col, stance_col) -> Column:
    low = F.lower(F.concat_ws(" ", text(theme_col), text(stance_col), text(x)))
    return let(low, lambda low: F.when(any_of(low, C.DIGEST_INVENTORY), "inventory").when(any_of(low, C.DIGEST_PRICE), "price").when(any_of(low, C.DIGEST_OUTLOOK), "outlook").otherwise("drivers"))


def digest_label(x) -> Column:
    clean = normalize_space(x)
    low = F.lower(clean)
    alu = F.contains(low, F.lit("aluminum")) | F.contains(low, F.lit("aluminium"))
    cu = F.contains(low, F.lit("copper"))
    return F.when(cu & alu, "Copper & Aluminium").when(cu, "Copper").when(alu, "Aluminium").when(F.contains(low, F.lit("broad")), "Broad Metals").when(low.isin("all", "all markets", "market", "markets", ""), "Market").otherwise(clean)


def external_score(title, url, snippet, hint, cfg: Config) -> Column:
    """Of candidates that an outside provider found; the url's features come from the url itself."""
    lex, w = cfg.lexicon, lambda c, n: F.when(c, n).otherwise(0)
    blob = F.concat_ws("\n", text(title), text(snippet), text(url))
    base = candidate_score(title, url, snippet, cfg) + relevance(title, snippet, lex) + w(has_target(blob, lex), 3) + contains_sum(F.lower(blob), lex.priority, 2) + w(market_context(blob, lex), 2)
    base = base + w(looks_like_article(url), 2) + w(looks_like_report(url), 1) - w(section_page(url), 8)
    exact = F.substring(text(hint), 1, 10) == cfg.target_date
    base = base + F.when(exact, 4).when(hint_matches(hint, cfg.target_date, cfg.run_date), 3).otherwise(0) + w(same_day_url(url, cfg.target_date), 6)
    return base - w(old_archive(url, cfg.target_date), 20)


def discovery_keywords(source: str, lexicon: Lexicon) -> Column:
    """All terms by which a source's pages are looked for; source: name of a struct or prefix of columns."""
    fixed = F.array(*[F.lit(t) for t in lexicon.direct + lexicon.analysis])
    own = [F.coalesce(F.col(f"{source}{c}"), F.array().cast("array<string>")) for c in ("search_terms", "category_terms", "include_hints", "report_terms")]
    return F.array_distinct(F.filter(F.transform(F.concat(fixed, *own), lambda t: F.lower(normalize_space(t))), lambda t: t != ""))
