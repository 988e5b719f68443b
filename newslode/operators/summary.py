"""Evidence, rule summary, brief rows, digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..config import Config
from ..functions import lexicon as L
from ..functions.text import any_of, bind, escape_html, let, normalize_space, sentences, stable_key, structured_points, text, truncate

#: Term lists of evidence: direct 3, broad 2, analysis 1, supply 1.
EVIDENCE = (C.EVIDENCE_DIRECT, C.EVIDENCE_BROAD, C.EVIDENCE_ANALYSIS, C.EVIDENCE_SUPPLY)
FIXTURE_EVIDENCE = (("thor", "erin"), ("ontion", "retion", "thble"), ("with", "from"), ("edtion", "hation"))
SECTIONS = ("price", "drivers", "inventory", "outlook")
#: Flags of a summary by the terms that raise them (fixed values).
RISKS = ((("uncertain",), "Article highlights uncertainty"), (("tariff", "trade"), "Trade-policy sensitivity"), (("china",), "China demand/supply dependence"), (("inventory", "stocks"), "Inventory trend sensitivity"))
WATCHES = ((("supply",), "Monitor supply-side developments"), (("demand",), "Monitor demand-side commentary"), (("premium", "inventory"), "Monitor inventories and premiums"))
NO_RISK, NO_WATCH = "No explicit risk flag extracted", "Monitor follow-up analyst notes"
NO_SIGNAL = "No clear signal in today's sources."
GROUP_ORDER = ("Copper", "Aluminium", "Copper & Aluminium", "Broad Metals", "Market")


def evidence_score(sentence: Column, lists=EVIDENCE) -> Column:
    return lowered_score(F.lower(sentence), lists)


def lowered_score(low: Column, lists=EVIDENCE) -> Column:
    return L.contains_sum(low, lists[0], 3) + L.contains_sum(low, lists[1], 2) + L.contains_sum(low, lists[2]) + L.contains_sum(low, lists[3])


def evidence_sentences(body, most: int = 8, lists=EVIDENCE) -> Column:
    """Sentences with a score, the highest first, of equals the earlier, the first of each regardless of case."""
    return evidence_among(sentences(body), most, lists)


def evidence_among(found: Column, most: int, lists=EVIDENCE) -> Column:
    """The same of sentences."""
    scored = F.transform(found, lambda s, i: let(F.lower(s), lambda low: F.struct((-lowered_score(low, lists)).alias("k"), i.alias("i"), s.alias("s"), low.alias("low"))))
    kept = F.sort_array(F.filter(scored, lambda x: x["k"] < 0))
    none = F.array().cast("array<struct<s:string,low:string>>")
    # No more than `most` are ever kept, so a sentence is compared with few.
    first = F.aggregate(kept, none, lambda got, x: F.when((F.size(got) >= most) | F.exists(got, lambda g: g["low"] == x["low"]), got).otherwise(F.concat(got, F.array(F.struct(x["s"].alias("s"), x["low"].alias("low"))))))
    return F.transform(first, lambda x: x["s"])


def evidence_rows(df: DataFrame, key: str, body: str, most: int = 8, lists=EVIDENCE) -> DataFrame:
    """The same as rows: key, rank, sentence, score."""
    found = df.select(key, F.posexplode(sentences(body)).alias("pos", "sentence")).withColumn("score", evidence_score(F.col("sentence"), lists)).where("score > 0")
    first = found.groupBy(key, F.lower("sentence").alias("low")).agg(F.max("score").alias("score"), F.min("pos").alias("pos"), F.min_by("sentence", "pos").alias("sentence"))
    w = Window.partitionBy(key).orderBy(F.col("score").desc(), "pos")
    return first.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).select(key, "rank", "sentence", "score")


def rule_summary(title, body, lists=EVIDENCE) -> Column:
    """struct(theme, stance, synopsis, key_points, risk_flags, watch_items). The body is split and lower-cased once for all that read it."""

    def flags(low: Column, rules, none: str) -> Column:
        named = F.array_compact(F.array(*[F.when(any_of(low, t), F.lit(n)) for t, n in rules]))
        return let(named, lambda got: F.when(F.size(got) > 0, F.slice(got, 1, 3)).otherwise(F.array(F.lit(none))))

    def told(x: Column) -> Column:
        return F.struct(x["chosen"].alias("chosen"), F.trim(F.array_join(x["chosen"], " ")).alias("synopsis"), flags(x["low"], RISKS, NO_RISK).alias("risk_flags"), flags(x["low"], WATCHES, NO_WATCH).alias("watch_items"))

    def shown(x: Column) -> Column:
        points = F.when(F.size(x["chosen"]) > 0, F.slice(x["chosen"], 1, 3)).otherwise(F.array(F.lit("Relevant commentary detected but extraction was thin.")))
        synopsis = F.when(x["synopsis"] != "", x["synopsis"]).otherwise(truncate(body, 400))
        return F.struct(L.theme(title, body).alias("theme"), L.stance(F.concat_ws("\n", text(title), text(body))).alias("stance"), synopsis.alias("synopsis"), points.alias("key_points"), x["risk_flags"].alias("risk_flags"), x["watch_items"].alias("watch_items"))

    chosen = let(sentences(body), lambda found: let(evidence_among(found, 5, lists), lambda best: F.when(F.size(best) > 0, best).otherwise(F.slice(found, 1, 4))))
    return let(F.struct(chosen.alias("chosen"), F.lower(text(body)).alias("low")), lambda x: let(told(x), shown))


def summary_or_rule(model: Column, rule: Column) -> tuple[Column, Column]:
    """(summary, mode): the model's where it says something, else the rule's."""
    from ..functions.json_repair import substantive

    ok = F.coalesce(substantive(model), F.lit(False))
    return F.when(ok, model).otherwise(rule), F.when(ok, "model").otherwise("rule")


def bullets(points: Column) -> Column:
    return F.array_join(F.transform(F.filter(points, lambda p: p != ""), lambda p: F.concat(F.lit("- "), p)), "\n")


def brief_rows(df: DataFrame, run_id: str, generated_at: str, cfg: Config) -> DataFrame:
    """The sink's nineteen string columns of articles beside their summary (struct summary, string mode)."""
    s = lambda c: F.col(f"summary.{c}")
    stance = normalize_space(s("stance"))
    published = text("published_at")
    return df.select(
        truncate(F.when(text("title") != "", F.col("title")).otherwise(F.concat(text("source_name"), F.lit(" Analyst Brief"))), 250).alias("Title"), F.when(published == "", F.lit(cfg.run_date)).otherwise(F.coalesce(F.date_format(F.try_to_timestamp(F.substring(published, 1, 10), F.lit("yyyy-MM-dd")), "yyyy-MM-dd"), F.lit(cfg.run_date))).alias("BriefDate"),
        F.col("source_name").alias("SourceName"), F.col("source_url").alias("SourceUrl"), published.alias("PublishedAt"), truncate("author", 255).alias("ArticleAuthor"), F.col("scope").alias("Metal"), truncate(normalize_space(s("theme")), 255).alias("Theme"),
        F.when(stance.isin("Bullish", "Bearish", "Neutral", "Mixed", "Unknown"), stance).otherwise("Neutral").alias("Stance"), truncate(normalize_space(s("synopsis")), 6000).alias("Synopsis"), truncate(bullets(s("key_points")), 6000).alias("KeyPoints"), truncate(bullets(s("risk_flags")), 4000).alias("RiskFlags"), truncate(bullets(s("watch_items")), 4000).alias("WatchItems"),
        F.lit(generated_at).alias("GeneratedAt"), F.col("mode").alias("GenerationMode"), truncate(F.array_join("warnings", "\n"), 4000).alias("Warnings"), truncate("body_text", 12_000).alias("RawExcerpt"), F.lit(run_id).alias("RunId"), stable_key("source_url", "title", published).alias("UniqueKey"),
    )


def excerpt(most: int = 5000) -> Column:
    part = lambda name, c: F.when(text(c) != "", F.concat(F.lit(f"{name}: "), text(c)))
    body = F.when(text("body_text") != "", text("body_text")).otherwise("No full body text was extracted; use title, metadata, and evidence carefully.")
    return truncate(F.concat_ws("\n\n", part("TITLE", "title"), part("AUTHOR", "author"), part("PUBLISHED_AT", "published_at"), body), most)


def evidence_packet(cfg: Config, lists=EVIDENCE) -> Column:
    """What a model is told of an article: where it is from, how it was read, and the parts of it that carry evidence."""
    from .ranking import first_paragraphs

    paragraphs = F.transform(first_paragraphs("body_text"), lambda p: truncate(p, 800))
    return F.struct(
        text("source_name").alias("source_name"), F.when(text("source_role") != "", text("source_role")).otherwise("market commentary").alias("source_role"), text("source_url").alias("source_url"), text("title").alias("title"), text("author").alias("author"), text("published_at").alias("published_at"),
        F.col("scope").alias("scope_hint"), text("fetch_method").alias("fetch_method"), text("extraction_method").alias("extraction_method"), F.col("score"), F.coalesce("warnings", F.array().cast("array<string>")).alias("warnings"),
        evidence_sentences("body_text", 8, lists).alias("evidence_sentences"), paragraphs.alias("key_paragraphs"), excerpt().alias("excerpt_for_model"),
    )


def relevance_packet(cfg: Config, lists=EVIDENCE) -> Column:
    """What the relevance gate is told: the article, what the page was verified to show, how it was accepted. Needs judged articles."""
    from .acceptance import override_allowed_for_article

    v, a, told = F.col("verification"), F.col("acceptance"), evidence_packet(cfg, lists)
    return F.struct(
        *[told[c].alias(c) for c in ("title", "source_name", "source_url", "source_role")], F.lit(cfg.target_date).alias("target_date"), told["published_at"].alias("published_at"), told["scope_hint"].alias("scope_hint"),
        v["page_type"].alias("page_type"), v["verified_metals"].alias("target_metals"), v["has_valid_same_day_date"].alias("same_day_valid"), v["has_market_context"].alias("market_context"), v["narrative_chars"].alias("narrative_chars"), v["quote_signal"].alias("quote_signal"), v["date_sources_checked"].alias("date_sources_checked"),
        a["score"].alias("acceptance_score"), a["reasons"].alias("acceptance_reasons"), F.concat(v["reject_reasons"], a["reject_reasons"]).alias("reject_reasons"), told["evidence_sentences"].alias("evidence_sentences"), told["key_paragraphs"].alias("key_paragraphs"),
        excerpt(2600).alias("excerpt_for_model"), override_allowed_for_article(v, cfg).alias("structure_override_possible"),
    )


#: What the relevance gate is asked and held to.
RELEVANCE_TASK = "Say whether this page, which was opened and verified, goes on to the day's synopsis."
VALID_SCOPES = ("Copper", "Aluminum", "Copper, Aluminum", "Broad Metals", "Not Relevant")
RELEVANCE_RULES = (
    "should_summarize is true only for pages of the target day.",
    "The page has to be about copper or aluminium; metals in general are not enough.",
    "Listings, archives, quote screens, price tables and data pages are refused unless the evidence shows plenty of prose of the day.",
    "A page of mostly figures, tables or widgets with little prose gets should_summarize=false.",
    "A page that is relevant as background only gets is_relevant=true and should_summarize=false.",
    "Go by the verified signals and the excerpt together, and add no facts.",
)


def relevance_prompt(cfg: Config, lists=EVIDENCE) -> Column:
    return F.to_json(F.struct(F.lit(RELEVANCE_TASK).alias("task"), F.array(*map(F.lit, VALID_SCOPES)).alias("valid_scopes"), F.array(*map(F.lit, RELEVANCE_RULES)).alias("rules"), relevance_packet(cfg, lists).alias("packet")))


def sources_used(rows: DataFrame, ord_: str = "ord", most: int = 8) -> DataFrame:
    """source, place: the first sources of the rows, each once, in the rows' order; empty names left out."""
    named = rows.select(normalize_space("SourceName").alias("source"), F.col(ord_).alias("row_ord")).where("source <> ''")
    first = named.groupBy("source").agg(F.min("row_ord").alias("row_ord")).orderBy("row_ord", "source").limit(most)
    return first.select("source", F.row_number().over(Window.orderBy("row_ord", "source")).cast("long").alias("place"))


def prompt(task: str, packet: Column, rules: tuple[str, ...]) -> Column:
    """One JSON text: task, rules, and the packet."""
    return F.to_json(F.struct(F.lit(task).alias("task"), F.array(*[F.lit(r) for r in rules]).alias("rules"), packet.alias("packet")))


def repair_prompt(raw, schema: str) -> Column:
    return F.concat(F.lit("Return valid JSON only, by this schema: "), F.lit(schema), F.lit("\nBroken output:\n"), F.substring(text(raw), 1, 12_000))


def digest_points(rows: DataFrame, ord_: str = "ord") -> DataFrame:
    """label, section, text, source, url, row and point order of brief rows; the first of equal points in a label's section."""
    rows = bind(rows.withColumn("row_ord", F.col(ord_)), Theme=normalize_space("Theme"), Stance=normalize_space("Stance"), Synopsis=normalize_space("Synopsis"))
    theme, stance, synopsis = F.col("Theme"), F.col("Stance"), F.col("Synopsis")
    point = lambda p, section: F.struct(normalize_space(p).alias("text"), section.alias("section"))
    by_text = lambda p: point(p, L.digest_section(p, theme, stance))
    tone = F.when((stance != "") & (theme != ""), F.concat(F.lit("Analyst tone remains "), F.lower(stance), F.lit(" around "), F.lower(theme), F.lit("."))).when((stance != "") & (synopsis != ""), F.concat(F.lit("Analyst tone remains "), F.lower(stance), F.lit(" based on the latest readable update.")))
    outlook = lambda p: point(p, F.lit("outlook"))
    points = F.concat(F.array(by_text(synopsis)), F.transform(structured_points("KeyPoints"), by_text), F.transform(structured_points("WatchItems"), outlook), F.transform(structured_points("RiskFlags"), outlook), F.array(outlook(F.coalesce(tone, F.lit("")))))
    rows = rows.select("row_ord", L.digest_label("Metal").alias("label"), normalize_space("SourceName").alias("source"), text("SourceUrl").alias("url"), F.posexplode(points).alias("point_ord", "p"))
    rows = rows.select("label", F.col("p.section").alias("section"), F.col("p.text").alias("text"), "source", "url", "row_ord", "point_ord").where(F.length("text") >= 18)
    row = F.struct("row_ord", "point_ord", "text", "source", "url")
    return rows.groupBy("label", "section", F.lower("text").alias("low")).agg(F.min(row).alias("r")).select("label", "section", "r.*")


def digest_groups(rows: DataFrame, ord_: str = "ord", most: int = 4) -> DataFrame:
    """label, section, place, text, source, url: four points of a section at most; an empty section takes the first two of
    drivers, price, inventory and outlook together. After the cut a label has a handful of points, so the rest happens in its own row."""
    points = digest_points(rows, ord_)
    own = points.withColumn("place", F.row_number().over(Window.partitionBy("label", "section").orderBy("row_ord", "point_ord"))).where(F.col("place") <= most)
    turn = F.array_position(F.array(*[F.lit(s) for s in ("drivers", "price", "inventory", "outlook")]), F.col("section"))
    held = own.groupBy("label").agg(F.array_sort(F.collect_list(F.struct(turn.alias("turn"), "place", "section", "text", "source", "url"))).alias("points"))
    told = lambda x, section, place: F.struct(section.alias("section"), place.alias("place"), x["text"].alias("text"), x["source"].alias("source"), x["url"].alias("url"))

    def of(section: str) -> Column:
        mine = F.filter("points", lambda x: x["section"] == section)
        lent = F.transform(F.slice("points", 1, 2), lambda x, i: told(x, F.lit(section), i + 1))
        return F.when(F.size(mine) > 0, F.transform(mine, lambda x: told(x, F.lit(section), x["place"]))).otherwise(lent)

    shown = F.explode(F.flatten(F.array(*[of(s) for s in SECTIONS]))).alias("x")
    return held.select("label", shown).select("label", "x.*")


def chip(source, url) -> Column:
    label = escape_html(F.when(text(source) != "", text(source)).otherwise("Source"))
    return F.when(text(url) != "", F.concat(F.lit('<a href="'), escape_html(url), F.lit('">'), label, F.lit("</a>"))).otherwise(F.concat(F.lit("<span>"), label, F.lit("</span>")))


def digest_html(groups: DataFrame, subject: str) -> DataFrame:
    """One row, html: the sections of each label, labels in their fixed order, then by name."""
    item = F.concat(F.lit("<li>"), escape_html("text"), F.lit(" "), chip("source", "url"), F.lit("</li>"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("place", item.alias("li")))), lambda x: x["li"])
    told = groups.groupBy("label", "section").agg(F.array_join(items, "").alias("items"))
    # Every label shows every section; one without points says so.
    every = groups.select("label").distinct().withColumn("section", F.explode(F.array(*[F.lit(x) for x in SECTIONS]))).join(told, ["label", "section"], "left")
    sections = every.select("label", "section", F.concat(F.lit("<h3>"), F.initcap("section"), F.lit("</h3><ul>"), F.coalesce("items", F.lit(f"<li>{NO_SIGNAL}</li>")), F.lit("</ul>")).alias("html"))
    order = F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.col("section"))
    labels = sections.groupBy("label").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("k"), "html"))), lambda x: x["html"]), "").alias("html"))
    rank = F.array_position(F.array(*[F.lit(g) for g in GROUP_ORDER]), F.col("label"))
    parts = F.array_sort(F.collect_list(F.struct(F.when(rank == 0, 99).otherwise(rank).alias("k"), "label", "html")))
    body = F.array_join(F.transform(parts, lambda x: F.concat(F.lit("<h2>"), escape_html(x["label"]), F.lit("</h2>"), x["html"])), "")
    # A digest holds four points of four sections for each label: small by construction.
    return labels.agg(F.concat(F.lit(f"<html><head><title>{subject}</title></head><body>"), F.coalesce(body, F.lit("")), F.lit("</body></html>")).alias("html"))


def subject(count: int, scope: str, day: str) -> str:
    return f"Analyst Brief Alert | {count} new {'item' if count == 1 else 'items'} | {scope if scope and scope != 'All' else 'All Markets'} | {day}"
