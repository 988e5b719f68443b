"""Best of each key, merges, tops and orders; every fold has a total order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import Config
from ..functions.text import any_of, distinct_by, let, normalize_space, text


def best_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key: the greatest by order. Combines before it shuffles."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("row")).select("row.*")


def dedupe_by_url(df: DataFrame, url: str = "norm_url", score: str = "score", ord_: str = "ord") -> DataFrame:
    """The row of highest score for each url; ties keep the first seen."""
    return best_by(df, [url], [F.col(score), -F.col(ord_)])


def merge_candidates(df: DataFrame, keys: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row for each key: that of the highest score (the earlier of equals, by stage if there are any, then ord), with the longest of each hint."""
    early = F.struct(*[(-F.col(c)).alias(c) for c in ("stage_ord", "ord") if c in df.columns])
    hints = [F.max_by(c, F.struct(F.length(text(c)).alias("n"), early.alias("e"))).alias(c) for c in ("title_hint", "snippet_hint", "published_hint")]
    rest = [c for c in df.columns if c not in (*keys, "title_hint", "snippet_hint", "published_hint")]
    best = F.max_by(F.struct(*rest), F.struct(F.col("score"), early.alias("e"))).alias("best")
    return df.groupBy(*keys).agg(best, *hints).select(*keys, "title_hint", "snippet_hint", "published_hint", "best.*")


def top_per(df: DataFrame, keys: list[str], order: list[Column], most: int, rank: str = "rank") -> DataFrame:
    """The first rows of each key; Spark cuts each task's share before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= most)


def final_order(df: DataFrame, most: int, key: str = "source_url") -> DataFrame:
    """By date, then score, the latest and highest first, an undated row last, the key for ties."""
    return df.orderBy(F.col("published_at").desc(), F.col("score").desc(), F.col(key)).limit(most)


def article_rank(relevance: Column) -> Column:
    return F.struct(relevance.alias("r"), F.length(text("body_text")).alias("n"), (text("published_at") != "").alias("d"), (F.col("scope") != "Unknown").alias("s"), (~F.contains(text("extraction_method"), F.lit("metadata_only"))).alias("m"))


def page_rank() -> Column:
    """Of an extracted page: verification, then relevance, then length. Needs the column relevance."""
    v = F.col("verification")
    return F.struct(v["score"].alias("a"), v["has_valid_same_day_date"].alias("b"), v["has_target_metal"].alias("c"), v["has_market_context"].alias("d"), F.col("relevance").alias("e"), F.length(text("body_text")).alias("f"))


def better_page(df: DataFrame, url: str, rank: Column, attempt: str = "attempt") -> DataFrame:
    """Between variants of a page the one of higher rank; of equals the later."""
    return best_by(df, [url], [rank, F.col(attempt)])


def capped_accepted(df: DataFrame, most: int, attempts: int) -> DataFrame:
    """Of each source's candidates, HTML before PDF, then in order, the first accepted ones among its first attempts."""
    tried = top_per(df, ["source_name"], [F.col("is_pdf"), F.col("candidate_rank")], attempts, "attempt")
    return top_per(tried.where("accepted"), ["source_name"], [F.col("attempt")], most, "accepted_rank")


def prefilter_floor(df: DataFrame, floor: int = 6, rescue: int = 6) -> DataFrame:
    """Keep accepted candidates, and rejected ones of score `rescue` while fewer than `floor` are kept.

    The running count is a recurrence, but a closed form exists: before the floor is reached every accepted
    and every rescuable row is kept, so the floor is reached at the floor-th of them. Only that row of each source
    is looked for, so a source with very many candidates isn't sorted in one task.
    """
    eligible = F.col("accepted") | (F.col("score") >= rescue)
    places = df.where(eligible).select(F.col("source_name").alias("__source"), F.col("candidate_rank").alias("__last"))
    last = top_per(places, ["__source"], [F.col("__last")], floor, "__place").where(F.col("__place") == floor).drop("__place")
    near = F.col("__last").isNull() | (F.col("candidate_rank") <= F.col("__last"))
    return df.join(last, F.col("source_name").eqNullSafe(F.col("__source")), "left").where(F.col("accepted") | ((F.col("score") >= rescue) & near)).select(*df.columns)


def html_first(df: DataFrame, max_articles: int, bounded: bool = False) -> DataFrame:
    """PDF rows only for sources whose accepted HTML rows are fewer than min(max_articles, 2).

    bounded: a source has few rows, so they may be counted side by side and df is computed once.
    """
    if bounded:
        n = F.sum((~F.col("is_pdf") & F.col("accepted")).cast("int")).over(Window.partitionBy("source_name"))
        return df.withColumn("n_html", n).where(~F.col("is_pdf") | (F.col("n_html") < min(max_articles, 2))).drop("n_html")
    html = df.where(~F.col("is_pdf") & F.col("accepted")).groupBy("source_name").agg(F.count("*").alias("n_html"))
    return df.join(html, "source_name", "left").where(~F.col("is_pdf") | (F.coalesce("n_html", F.lit(0)) < min(max_articles, 2))).drop("n_html")


@dataclass(frozen=True)
class Outside:
    """What changes for a source with candidates from outside: is_outside and signal (a reason to keep a candidate) of a row, the cap, the limit, and how many are kept at least."""

    is_outside: Column
    signal: Column
    cap: int
    limit: int
    floor: int = 12


def shortlist(df: DataFrame, score: Column, cap: int, limit: int, threshold: int, backfill: int, outside: Outside | None = None) -> DataFrame:
    """Of each source: HTML before PDF by score; `cap` rows at the threshold, HTML of them first up to half the limit (six at least),
    then backfill HTML, then those PDFs if HTML is short, then backfill PDF, and the rest of the limit from the pool.

    df has source_name, url, is_pdf, is_report, ord and only rows that may be listed. With outside candidates a source's threshold
    is 0 at most and its cap and limit are the higher ones; if the walk lists fewer than the floor, the first rows with a signal that
    it left out are listed after its own. Both counters have a closed form: the walk ends with the cap-th row at the threshold, and
    of the others so many are taken as are missing.
    """
    ranked = df.withColumn("list_score", score)
    if outside is None:
        has, signal = F.lit(False), F.lit(False)
        most = max(cap, limit)
    else:
        ranked = ranked.withColumn("signal", outside.signal)
        has_outside = ranked.where(outside.is_outside).select("source_name").distinct().withColumn("has_outside", F.lit(True))
        ranked = ranked.join(has_outside, "source_name", "left").withColumn("has_outside", F.coalesce("has_outside", F.lit(False)))
        has, signal = F.col("has_outside"), F.col("has_outside") & F.col("signal")
        most = max(cap, limit, outside.cap, outside.limit)
    own_cap = F.when(has, max(cap, outside.cap if outside else 0)).otherwise(cap)
    own_limit = F.when(has, max(limit, outside.limit if outside else 0)).otherwise(limit)
    floor = F.least(own_limit, F.lit(outside.floor if outside else 0))
    preferred = F.when(has, F.greatest(F.lit(6), F.floor(own_limit / 2), floor)).otherwise(max(6, limit // 2))
    ranked = ranked.withColumn("strong", F.col("list_score") >= F.when(has, min(threshold, 0)).otherwise(threshold))
    ranked = ranked.withColumn("pool", ~F.col("strong") & ((F.col("list_score") >= backfill) | F.col("is_report"))).withColumn("extra", signal)
    # Of each kind no more rows than the cap and the limit can count, so that no source is sorted whole in one task.
    ranked = top_per(ranked.where("strong OR pool OR extra"), ["source_name", "strong", "pool", "extra", "is_pdf"], [F.col("list_score").desc(), F.col("ord")], most, "kind_turn").drop("kind_turn")
    order = Window.partitionBy("source_name").orderBy(F.col("is_pdf"), F.col("list_score").desc(), F.col("ord"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("source_name")
    counted = lambda test, over: F.coalesce(F.sum(test.cast("int")).over(over), F.lit(0))
    ranked = ranked.withColumn("place", F.row_number().over(order)).withColumn("strong_before", counted(F.col("strong"), before))
    # The walk ends when the cap is reached; so many it has listed itself.
    ranked = ranked.withColumn("seen", F.col("strong_before") < own_cap).withColumn("listed", F.col("strong") & F.col("seen"))
    left = F.col("extra") & ~F.col("listed")
    missing = floor - F.least(own_cap, counted(F.col("strong"), whole))
    ranked = ranked.withColumn("added", left & (counted(left, before) < missing))
    ranked = ranked.withColumn("is_listed", F.col("listed") | F.col("added")).withColumn("turn", F.sum((F.col("is_listed") & ~F.col("is_pdf")).cast("int")).over(Window.partitionBy("source_name").orderBy("added", "place")))
    ranked = ranked.withColumn("html", counted(F.col("is_listed") & ~F.col("is_pdf"), whole))
    as_listed = F.when(F.col("is_listed") & ~F.col("is_pdf") & (F.col("turn") <= preferred), 1).when(F.col("is_listed") & F.col("is_pdf") & (F.col("html") < preferred), 3)
    as_pool = F.when(F.col("pool") & F.col("seen"), F.when(F.col("is_pdf"), 4).otherwise(2))
    # A row that was added may stand in the pool as well; it counts twice for the limit and is returned once.
    roles = F.explode(F.filter(F.array(as_listed, as_pool), lambda b: b.isNotNull()))
    listed = ranked.withColumn("own_limit", own_limit).withColumn("bucket", roles)
    listed = top_per(listed, ["source_name"], [F.col("bucket"), F.col("added"), F.col("place")], most, "list_rank").where(F.col("list_rank") <= F.col("own_limit"))
    return best_by(listed, ["source_name", "url"], [-F.col("list_rank")]).drop("strong_before", "turn", "place", "strong", "pool", "extra", "seen", "listed", "added", "is_listed", "html", "own_limit", "has_outside", "signal")


def count_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def shortlist_counters(df: DataFrame, cfg: Config) -> DataFrame:
    """Of listed candidates, by method: how many, with a target and a priority term in title or snippet, with a hint of the day, with the day in the url."""
    from ..functions import lexicon as L
    from ..functions import url as U
    from ..functions.dates import hint_matches

    told = F.concat_ws("\n", text("title_hint"), text("snippet_hint"), text("url"))
    strong = L.has_target(told, cfg.lexicon) & any_of(F.lower(told), cfg.lexicon.priority)
    return df.groupBy("method").agg(F.count("*").alias("n_listed"), F.count_if(strong).alias("n_title_snippet"), F.count_if(hint_matches("published_hint", cfg.target_date, cfg.run_date)).alias("n_date_hint"), F.count_if(U.same_day_url("url", cfg.target_date)).alias("n_url_date"))


def first_paragraphs(body, most: int = 4) -> Column:
    """All paragraphs if there are few, else the first two and last two, the first of equals."""

    def told(ps: Column) -> Column:
        few = distinct_by(F.concat(F.slice(ps, 1, 2), F.slice(ps, F.greatest(F.size(ps) - 1, F.lit(1)), 2)), F.lower)
        return F.when(F.size(ps) <= most, ps).otherwise(F.slice(few, 1, most))

    return let(F.filter(F.transform(F.split(text(body), r"\n+"), normalize_space), lambda p: p != ""), told)
