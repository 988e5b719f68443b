"""The table of sources: a small dimension that joins broadcast to candidates and articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import url as U
from ..functions.dom import PROFILE_BODY, compiled, valid_selectors
from ..functions.text import any_of, dedupe_lower, normalize_space, text

SCHEMA = "source_name string, seed_urls array<string>, allowed_hosts array<string>, sitemap_urls array<string>, rss_urls array<string>, include_hints array<string>, exclude_hints array<string>, category_terms array<string>, search_terms array<string>, report_terms array<string>, js_heavy boolean, paywalled_preview_ok boolean, min_body_chars int, pdf_report_ok boolean, source_role string, article_body_selectors array<string>"
LISTS = ("seed_urls", "allowed_hosts", "sitemap_urls", "rss_urls", "include_hints", "exclude_hints", "category_terms", "search_terms", "report_terms")

#: Selectors of an article's body for sources whose name holds a word (fixed values; the first that fits).
PROFILES = (
    ("reuters", ("main article", "article", "[data-testid*='article-body']", "main", ".article-body")),
    ("capital.com", ("article", "main", ".article-content", ".post-content", ".rich-text")),
    ("argus", ("article", ".article-content", ".content", "main")),
    ("fitch", ("article", ".article-content", ".entry-content", "main")),
    ("ainvest", ("article", ".article-content", ".rich-text", "main")),
    ("discovery", ("article", ".entry-content", ".article-content", "main")),
    ("metal.com", ("article", ".article-content", ".news-content", ".content", "main")),
    ("smm", ("article", ".article-content", ".news-content", ".content", "main")),
    ("lme", ("article", ".article-content", ".rich-text", "main")),
)

#: Terms of categories and of searches: of every source, and of those whose name or urls hold a word (fixed values).
EVERY_CATEGORY = ("copper", "aluminum", "aluminium", "base metals", "industrial metals", "market", "analysis")
EVERY_SEARCH = ("copper", "aluminum", "aluminium", "base metals", "market analysis", "analyst review")
TERMS = (
    (("lme",), ("lme", "stocks", "warehousing", "non-ferrous", "market data"), ("lme copper", "lme aluminium", "warehousing", "non-ferrous")),
    (("reuters",), (), ("industrial metals analysis", "andy home")),
    (("argus",), ("latest market news",), ("latest market news", "base metals")),
    (("capital",), ("commodity", "commodities"), ("commodities", "commodity outlook")),
    (("fitch",), ("commodities", "metals", "mining", "insights"), ("metals mining", "commodities")),
    (("metal.com", "smm"), ("news", "smm analysis", "physical market"), ("copper news", "aluminum news", "SMM analysis")),
    (("ainvest",), ("materials",), ("materials", "market")),
    (("discoveryalert", "discovery alert"), ("volatility", "market commentary"), ("market commentary", "base metals")),
    (("brecorder",), ("commodities", "markets", "news"), ("commodities market", "copper news", "aluminum news")),
    (("investing",), ("commodities", "market data", "price", "futures"), ("copper commodity price", "copper futures", "commodity market data")),
    (("tradingeconomics",), ("commodity", "market data", "forecast", "historical data"), ("copper commodity forecast", "aluminum commodity forecast", "commodity data")),
    (("businessinsider",), ("commodities", "price", "market data"), ("aluminum price", "commodity price")),
    (("mordor",), ("industry reports", "market analysis", "outlook"), ("aluminum market outlook", "market analysis", "industry report")),
    (("fortunebusinessinsights", "fortune business insights"), ("industry reports", "forecast", "market size"), ("metals and minerals industry report", "market outlook", "industry forecast")),
)


def default_terms(name, urls: Column) -> tuple[Column, Column]:
    """Terms of categories and of searches for a source by its name and urls, the first of each regardless of case, lower-cased."""
    label = F.lower(F.concat_ws(" ", text(name), F.array_join(F.coalesce(urls, F.array().cast("array<string>")), " ")))
    parts = [[F.array(*map(F.lit, e)) for e in (EVERY_CATEGORY, EVERY_SEARCH)]]
    for words, *lists in TERMS:
        parts.append([F.when(any_of(label, words), F.array(*map(F.lit, x))).otherwise(F.array().cast("array<string>")) if x else F.array().cast("array<string>") for x in lists])
    return tuple(dedupe_lower(F.concat(*[p[i] for p in parts])) for i in (0, 1))


def with_defaults(specs: DataFrame) -> DataFrame:
    """Terms by name and urls where none are given, empty lists for other nulls, hosts inferred from seeds, terms lower-cased, a floor for the body, a known role."""
    from ..operators.acceptance import min_body_chars, role_of

    out = specs
    categories, searches = default_terms("source_name", F.col("seed_urls"))
    out = out.withColumn("category_terms", F.coalesce("category_terms", categories)).withColumn("search_terms", F.coalesce("search_terms", searches))
    for c in LISTS:
        out = out.withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    for c in ("include_hints", "exclude_hints", "category_terms", "search_terms", "report_terms"):
        out = out.withColumn(c, dedupe_lower(F.col(c)))
    out = out.withColumn("allowed_hosts", F.when(F.size("allowed_hosts") > 0, F.transform("allowed_hosts", F.lower)).otherwise(U.inferred_hosts(F.col("seed_urls"))))
    out = out.withColumn("min_body_chars", min_body_chars(F.coalesce("min_body_chars", F.lit(120)))).withColumn("source_role", role_of("source_role"))
    by_name = F.lit(None).cast("array<string>")
    for part, selectors in reversed(PROFILES):
        by_name = F.when(F.contains(F.lower("source_name"), F.lit(part)), F.array(*map(F.lit, selectors))).otherwise(by_name)
    given = F.filter("article_body_selectors", lambda x: normalize_space(x) != "")
    out = out.withColumn("article_body_selectors", F.coalesce(given, by_name, F.array(*map(F.lit, PROFILE_BODY))))
    out = out.withColumn("body_steps", compiled("article_body_selectors")).withColumn("article_body_selectors", valid_selectors("article_body_selectors"))
    for c, default in (("js_heavy", False), ("paywalled_preview_ok", False), ("pdf_report_ok", True)):
        out = out.withColumn(c, F.coalesce(c, F.lit(default)))
    return out


def from_specs(spark: SparkSession, specs: list[dict]) -> DataFrame:
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    known = {s.get("source_name") for s in specs}
    if None in known or len(known) != len(specs):
        raise ValueError("every source needs a name of its own")
    return with_defaults(spark.createDataFrame([tuple(s.get(n) for n in names) for s in specs], SCHEMA))


def from_json(spark: SparkSession, path: str) -> DataFrame:
    return with_defaults(spark.read.schema(SCHEMA).option("multiLine", True).json(path))


def extra_sources(spark: SparkSession, urls: str) -> DataFrame:
    """A source for each host of a list of urls: `a;b` or one a line."""
    rows = spark.createDataFrame([(urls,)], "u string").select(F.explode(F.filter(F.transform(F.split(text("u"), r"[;,\n]"), F.trim), lambda x: x != "")).alias("seed"))
    specs = rows.groupBy(U.host_of("seed").alias("source_name")).agg(F.array_sort(F.collect_set("seed")).alias("seed_urls"))
    for f in SCHEMA.split(", ")[2:]:
        name, kind = f.split(" ", 1)
        specs = specs.withColumn(name, F.lit(None).cast(kind))
    return with_defaults(specs)


def prioritized_seeds(sources: DataFrame) -> DataFrame:
    """source_name, url, ord: seeds, the first of each normalised url."""
    rows = sources.select("source_name", F.posexplode("seed_urls").alias("ord", "url")).withColumn("norm", U.normalize_url("url"))
    return rows.groupBy("source_name", "norm").agg(F.min_by("url", "ord").alias("url"), F.min("ord").alias("ord")).select("source_name", "url", "ord")


def check_names(sources: DataFrame, names: list[str]) -> list[str]:
    """Names that no source has: a configuration error to report when it is loaded."""
    known = {r[0] for r in sources.select("source_name").collect()}
    return [n for n in names if n not in known]


def fixture(spark: SparkSession) -> DataFrame:
    """Three roles over the hosts of the test pages."""
    base = {"seed_urls": [], "sitemap_urls": [], "rss_urls": [], "category_terms": [], "search_terms": [], "report_terms": ["report"], "js_heavy": False, "pdf_report_ok": True}
    return from_specs(
        spark,
        [
            base | {"source_name": "news", "allowed_hosts": ["example.com"], "include_hints": [], "exclude_hints": ["/private/"], "paywalled_preview_ok": True, "min_body_chars": 200, "source_role": "narrative_news"},
            base | {"source_name": "data", "allowed_hosts": ["example.net"], "include_hints": ["en"], "exclude_hints": [], "paywalled_preview_ok": False, "min_body_chars": 400, "source_role": "market_data"},
            base | {"source_name": "research", "allowed_hosts": ["example.org"], "include_hints": [], "exclude_hints": [], "paywalled_preview_ok": False, "min_body_chars": 300, "source_role": "market_research"},
        ],
    )
