"""Side effects stay outside the engine: each connector is an interface with an offline form.

A fetcher, a search or a model is a table that some other job fills. The engine joins to
it, so that a plan can be run again and gives the same rows.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import first_nonempty, text


class Fetcher(Protocol):
    """raw_pages of urls: requested_url, final_url, status_code, html, text, title, content_type, method, attempt, warnings."""

    def fetch(self, urls: DataFrame) -> DataFrame: ...


class Model(Protocol):
    """key, response of prompts (key, prompt)."""

    def generate(self, prompts: DataFrame) -> DataFrame: ...


class TableFetcher:
    """Pages fetched before, keyed by url."""

    def __init__(self, pages: DataFrame, url: str = "url", html: str = "html"):
        self.pages, self.url, self.html = pages, url, html

    def fetch(self, urls: DataFrame) -> DataFrame:
        return urls.select("url").distinct().join(self.pages.select(F.col(self.url).alias("url"), F.col(self.html).alias("html")), "url").select(F.col("url").alias("requested_url"), F.col("url").alias("final_url"), F.lit(200).alias("status_code"), "html", F.lit("table").alias("method"), F.lit(0).alias("attempt"))


class TableModel:
    """Responses written before, keyed by prompt key."""

    def __init__(self, responses: DataFrame):
        self.responses = responses

    def generate(self, prompts: DataFrame) -> DataFrame:
        return prompts.select("key").join(self.responses, "key", "left")


#: Statuses that stand for what was never asked or never answered (fixed values).
ROBOTS_STATUS, PAUSED_STATUS, FAILED_STATUS = 999, 429, 599
#: Ways of fetching in the order in which they are tried.
WAYS = ("http", "dynamic", "stealthy")


def answered(attempts: DataFrame) -> DataFrame:
    """Attempts with a status for those that were not made or not answered: robots (robots_ok false) before a paused host (paused true) before no answer (null status)."""
    robots, paused = F.coalesce("robots_ok", F.lit(True)), F.coalesce("paused", F.lit(False))
    asked = robots & ~paused
    status = F.when(~robots, ROBOTS_STATUS).when(paused, PAUSED_STATUS).otherwise(F.coalesce("status_code", F.lit(FAILED_STATUS)))
    method = F.when(~robots, "robots_blocked").when(paused, "host_paused").when(F.col("status_code").isNull(), "failed").otherwise(F.col("method"))
    return attempts.withColumns({"answer": method, "status": status.cast("int"), "html": F.when(asked, text("html")).otherwise(""), "body": F.when(asked, text("body")).otherwise(""), "title": F.when(asked, text("title")).otherwise("")})


def escalated(attempts: DataFrame, kind: str, floor: int, allow_dynamic: bool = True, js_heavy: Column | bool = False) -> DataFrame:
    """The page of each requested_url: the plain fetch; a rendered one if the plain is weak and the source or the kind asks
    for it; a stealthy one if the better of the two is blocked or weak. A later page is taken only if it is strictly better.

    attempts: requested_url, method, status, html, title, body, answer (see answered()), what each way gives or would give. A way
    without a row is a failed one. Adds quality and n_tried. Of several rows of a way the one of the greatest hash counts.
    """
    from ..functions.html import block_page
    from ..operators.acceptance import page_quality, should_go_stealthy, should_render

    seen = attempts.withColumns({
        "quality": page_quality("status", "html", "body", "title", kind, floor),
        "wants_render": should_render("status", "html", "body", "title", kind, floor, allow_dynamic, js_heavy),
        "wants_stealth": should_go_stealthy("status", "html", "body", "title", kind, floor, allow_dynamic),
        "blocked": block_page("html"),
    })
    fields = ["answer", "status", "html", "title", "body", "quality", "wants_render", "wants_stealth", "blocked"]
    row = F.struct(*[F.col(c) for c in fields])
    ways = [F.max_by(F.when(F.col("method") == w, row), F.when(F.col("method") == w, F.xxhash64(*fields))).alias(w) for w in WAYS]
    rows = seen.groupBy("requested_url").agg(*ways)
    none = F.struct(F.lit("failed").alias("answer"), F.lit(FAILED_STATUS).alias("status"), *[F.lit("").alias(c) for c in ("html", "title", "body")], F.lit(0).alias("quality"), F.lit(allow_dynamic).alias("wants_render"), F.lit(allow_dynamic).alias("wants_stealth"), F.lit(False).alias("blocked"))
    rows = rows.select("requested_url", F.coalesce("http", none).alias("first"), "dynamic", "stealthy").withColumn("rendered", F.col("first.wants_render"))
    better = lambda new, old, tried: F.when(tried & F.coalesce(F.col(f"{new}.quality") > F.col(f"{old}.quality"), F.lit(False)), F.col(new)).otherwise(F.col(old))
    rows = rows.withColumn("second", better("dynamic", "first", F.col("rendered"))).withColumn("stealth", F.col("second.wants_stealth"))
    rows = rows.withColumn("best", better("stealthy", "second", F.col("stealth")))
    return rows.select("requested_url", *[f"best.{c}" for c in ("answer", "status", "html", "title", "body", "quality", "blocked")], (1 + F.col("rendered").cast("int") + F.col("stealth").cast("int")).alias("n_tried"))


def backoff_seconds(attempt: Column) -> Column:
    return F.least(F.lit(6.0), attempt * 1.5)


def normalize_external(payload: Column) -> Column:
    """struct(url, title_hint, snippet_hint, published_hint) of an outside provider's JSON item."""
    get = lambda *keys: first_nonempty(*[F.get_json_object(payload, f"$.{k}") for k in keys])
    return F.struct(get("url", "link", "metadata.sourceURL").alias("url"), get("title", "metadata.title", "metadata.ogTitle").alias("title_hint"), get("description", "snippet", "metadata.description").alias("snippet_hint"), get("publishedDate", "published", "date", "metadata.publishedTime").alias("published_hint"))


def external_candidates(spark: SparkSession, path: str, method: str = "external_search") -> DataFrame:
    """Items of JSON files, one object a line, as candidates: one of each url, chosen by a hash of the line, which no split of the files changes."""
    rows = spark.read.text(path).where(F.trim("value") != "").select(normalize_external(F.col("value")).alias("c"), F.shiftright(F.xxhash64("value"), 1).alias("ord")).select("c.*", "ord", F.lit(method).alias("method"))
    from ..operators.ranking import best_by

    return best_by(rows.where(F.col("url") != ""), ["url"], [-F.col("ord")])


def external_rescue(articles: DataFrame, fetched: DataFrame) -> DataFrame:
    """Articles whose own page gave no body take the outside provider's text (fetched: source_url, markdown)."""
    own = articles.join(fetched, "source_url", "left")
    empty = text("body_text") == ""
    return own.withColumn("fetch_method", F.when(empty & F.col("markdown").isNotNull(), "external_scrape").otherwise(F.col("fetch_method"))).withColumn("body_text", F.when(empty, F.coalesce("markdown", F.lit(""))).otherwise(F.col("body_text"))).drop("markdown")


def backend_order(choice: str, local_first: bool = False) -> list[str]:
    """Backends in the order in which they are asked; the rule is always last."""
    order = ["local", "hosted"] if local_first else ["hosted", "local"]
    return {"rule": ["rule"], "hosted": ["hosted", "rule"], "local": ["local", "rule"]}.get(choice, [*order, "rule"])


def robots_allow(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls not under a disallowed path of their host (rules: host, disallow); a host without rules is open."""
    from ..functions.url import host_of, path_of

    bad = urls.withColumn("host", host_of("url")).join(rules, "host").where((F.col("disallow") != "") & F.startswith(path_of("url"), F.col("disallow"))).select("url").distinct()
    return urls.join(bad, "url", "left_anti")
