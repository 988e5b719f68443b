"""Settings and word lists. Nothing in an expression reads the environment: both are parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

# The lists, weights and limits below decide results and are stated as they have to be.


@dataclass(frozen=True)
class Lexicon:
    """Lower-case terms, matched as substrings unless boundary is set."""

    targets: dict[str, tuple[str, ...]]
    symbols: dict[str, str]
    broad: tuple[str, ...]
    analysis: tuple[str, ...]
    priority: tuple[str, ...]
    intelligence: tuple[str, ...]
    structure: tuple[str, ...]
    company: tuple[str, ...]
    negative: tuple[str, ...]
    symbol_extra: tuple[str, ...] = ()
    labels: dict[str, str] = field(default_factory=dict)
    boundary: bool = False

    @property
    def primary(self) -> tuple[str, ...]:
        return tuple(t for ts in self.targets.values() for t in ts)

    @property
    def symbol_context(self) -> tuple[str, ...]:
        return self.intelligence + self.structure + self.symbol_extra

    @property
    def direct(self) -> tuple[str, ...]:
        return self.primary + self.broad


PRODUCTION = Lexicon(
    targets={"copper": ("copper",), "aluminum": ("aluminum", "aluminium")},
    symbols={"copper": "cu", "aluminum": "al"},
    broad=("base metals", "industrial metals", "metals", "metal", "non-ferrous", "nonferrous", "mining", "smelter", "smelters", "refined metal", "concentrate", "cathode", "wire rod", "scrap", "ore", "warehouse", "inventories", "supply", "demand", "lme"),
    analysis=("analysis", "outlook", "commentary", "review", "insight", "insights", "forecast", "market", "market news", "pricing", "premiums", "treatment charges"),
    priority=("copper", "aluminum", "aluminium", "market", "news", "analysis", "outlook", "commentary", "update", "alert"),
    intelligence=("news", "market news", "market update", "update", "alert", "analysis", "analyst analysis", "commentary", "insight", "outlook", "report", "research", "review", "trend", "market signal", "exchange update", "inventory update", "supply update", "demand update", "price move", "price trend"),
    structure=("lme", "comex", "shfe", "inventory", "stocks", "warehouse", "spread", "premium", "deficit", "surplus", "demand", "supply", "smelter", "mine", "tariff", "arbitrage", "cathode", "concentrate", "scrap", "futures"),
    company=("earnings", "quarter results", "stock price", "shares rose", "shares fell", "dividend", "ceo", "acquisition", "merger", "lawsuit"),
    negative=("crypto", "bitcoin", "ethereum", "etf", "s&p 500", "nasdaq"),
    symbol_extra=("commodity", "commodities", "price", "prices", "cash", "3m", "three-month", "exchange", "metal", "metals", "grade", "benchmark"),
    labels={"copper": "Copper", "aluminum": "Aluminum"},
)

#: The words that the test tables hold in the place of the production terms.
FIXTURE = Lexicon(
    targets={"copper": ("thor",), "aluminum": ("erin",)},
    symbols={},
    broad=("ontion", "retion", "thble"),
    analysis=("with", "from"),
    priority=("thor", "erin", "with", "heen"),
    intelligence=("that", "from"),
    structure=("edtion", "hation"),
    company=("onst", "anth"),
    negative=("ndble",),
    labels={"copper": "Copper", "aluminum": "Aluminum"},
)

STANCE_BULL = ("bullish", "supportive", "upside", "tight supply", "higher prices", "rebound", "recovery")
STANCE_BEAR = ("bearish", "downside", "oversupply", "weaker demand", "lower prices", "pressure", "slowdown")
THEMES = (
    (("supply", "smelter", "mine", "concentrate"), "Supply outlook"),
    (("demand", "consumption", "construction"), "Demand outlook"),
    (("tariff", "trade", "import", "export"), "Trade and policy"),
    (("premium", "inventory", "stocks", "warehouse"), "Market structure"),
    (("forecast", "outlook", "analysis", "insights"), "Analyst outlook"),
    (("base metals", "industrial metals"), "Broad metals commentary"),
)
THEME_DEFAULT = "General market commentary"
EVIDENCE_DIRECT = ("copper", "aluminum", "aluminium", "primary aluminum", "primary aluminium", "red metal")
EVIDENCE_BROAD = ("base metals", "industrial metals", "metal markets", "metals market", "non-ferrous metals", "commodity metals")
EVIDENCE_ANALYSIS = ("news", "analysis", "market analysis", "markets", "analyst", "commentary", "report", "research note", "outlook", "market outlook", "price outlook", "forecast", "weekly outlook", "monthly outlook", "trend", "trend signals", "sentiment", "bullish", "bearish", "neutral", "mixed outlook", "base metals outlook", "industrial metals outlook", "commodities", "insights")
EVIDENCE_SUPPLY = ("supply", "demand", "inventory", "inventories", "stocks", "warehouse", "premiums", "smelter", "smelters", "refined", "concentrate", "mine", "mining", "output", "production", "consumption", "imports", "exports", "tariff", "trade", "surplus", "deficit", "china", "lme", "comex", "shfe", "rod", "cathode")
DIGEST_PRICE = ("price", "prices", "pricing", "rally", "momentum", "support", "resistance", "upside", "downside", "premium", "premiums", "spread", "backwardation", "contango", "comex", "shfe", "lme", "stockpiling")
DIGEST_DRIVER = ("tariff", "trade", "policy", "policy risk", "demand", "supply", "electrification", "ai", "china", "construction", "manufacturing", "macro", "growth", "stimulus", "smelter", "mine", "production", "consumption")
DIGEST_INVENTORY = ("inventory", "inventories", "stocks", "warehouse", "warehousing", "flow", "flows", "arbitrage", "drawdown", "cancelled warrants", "surplus", "deficit", "tightness")
DIGEST_OUTLOOK = ("outlook", "forecast", "expects", "expectation", "guidance", "watch", "monitor", "risk", "stance", "bullish", "bearish", "neutral", "mixed", "signal", "signals")
EXCLUDED_PAGES = ("category_page", "archive_page", "market_data_page", "quote_page", "ticker_page", "futures_table_page", "symbol_landing_page")
SCOPE_ALIASES = {"copper": "Copper", "aluminum": "Aluminum", "aluminium": "Aluminum", "broad-metals": "Broad Metals", "broad metals": "Broad Metals", "broad": "Broad Metals", "copper,aluminum": "Copper, Aluminum", "copper aluminum": "Copper, Aluminum", "both": "Copper, Aluminum", "all": "All"}
SCOPE_LATTICE = {"Copper": ("Copper", "Copper, Aluminum"), "Aluminum": ("Aluminum", "Copper, Aluminum"), "Broad Metals": ("Broad Metals",), "Copper, Aluminum": ("Copper", "Aluminum", "Copper, Aluminum")}
BAD_PATHS = ("/tag/", "/tags/", "/author/", "/authors/", "/category/", "/categories/", "/login", "/signin", "/signup", "/register", "/privacy", "/terms", "/contact", "/about", "/careers", "/events", "/podcast", "/podcasts", "/video", "/videos")
REPORT_PATHS = (".pdf", "/report", "/reports", "/research", "/whitepaper", "/outlook", "/forecast", "/insight", "/insights", "/analysis", "/market-report")
SECTION_WORDS = ("news", "analysis", "markets", "market", "insights", "insight", "commentary", "outlook", "reports", "report", "articles", "latest", "metals", "commodities", "updates", "alerts")
RELATIVE_DAYS = ("today", "just now", "hour ago", "hours ago", "minute ago", "minutes ago")
QUOTE_URLS = ("/prices/", "/price/", "/future/", "/futures/", "/quotes/", "/quote/", "/spot/", "/symbol/", "/ticker/", "/lme/", "/shfe/", "/comex/")
OLD_PAGE_HOSTS = ("reuters.com",)
DYNAMIC_METHODS = ("dynamic_card", "dynamic_listing", "dynamic_second_hop", "dynamic_scrapy")
ALLOWED_SCOPES = ("Copper", "Aluminum", "Copper, Aluminum", "Broad Metals", "Not Relevant")
BLOCK_PHRASES = ("checking your browser", "cf-browser-verification", "attention required", "access denied", "captcha", "verify you are human")
HARD_REJECTS = (
    "date_mismatch_after_full_page_check", "missing_date_after_full_page_check", "missing_target_metal_after_page_check", "missing_market_context_after_page_check",
    *(f"page_type_{p}" for p in EXCLUDED_PAGES), "insufficient_narrative_body", "quote_signal_high", "market_data_reference_only", "market_research_background_only",
)


@dataclass(frozen=True)
class Config:
    """Numbers that decide results; the defaults are the daily run's."""

    run_date: str = "2026-04-07"
    target_date: str = "2026-04-07"
    lexicon: Lexicon = FIXTURE
    max_candidates: int = 80
    shortlist_threshold: int = 2
    backfill_threshold: int = 1
    non_target_penalty: int = 4
    pdf_score_penalty: int = 2
    html_score_bonus: int = 1
    shortlist_non_target_penalty: int = 5
    shortlist_pdf_penalty: int = 3
    shortlist_html_bonus: int = 1
    narrative_chars: int = 450
    narrative_paragraphs: int = 3
    override_chars: int = 700
    override_paragraphs: int = 4
    override_density: float = 0.28
    data_chars: int = 650
    data_paragraphs: int = 4
    data_density: float = 0.24
    data_table_density: float = 0.18
    research_chars: int = 520
    topic_threshold: int = 4
    accept_score: int = 4
    preview_chars: int = 55
    report_chars: int = 90
    min_body_chars: int = 120
    longform_chars: int = 450
    longform_score: int = 4
    short_body_score: int = 6
    rescue_body_chars: int = 700
    rescue_score: int = 5
    per_source_limit: int = 6
    max_articles_total: int = 12
    headroom: int = 3
    prefilter_floor: int = 6
    search_threshold: int = 14
    outside_threshold: int = 12
    outside_floor: int = 12
    outside_cap_ratio: float = 0.9
    merge_mode: str = "longest_wins"
    on_error: str = "keep"
    extra: dict = field(default_factory=dict)
