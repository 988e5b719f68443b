"""Feeds and sitemaps from fetched text, by Spark's XPath functions; binary and PDF sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import lexicon as L
from ..functions import url as U
from ..functions.dates import parse_iso
from ..functions.text import normalize_space, text

SITEMAP_PATHS = ("/sitemap.xml", "/sitemap_index.xml", "/news-sitemap.xml", "/sitemap-news.xml")


def plain_xml(xml: Column) -> Column:
    """Without declaration, doctype and name spaces, which XPath would have to name."""
    out = F.regexp_replace(text(xml), r"(?s)<\?xml.*?\?>|<!DOCTYPE[^>]*>", "")
    return F.regexp_replace(F.regexp_replace(out, r"\sxmlns(:\w+)?=\"[^\"]*\"", ""), r"(</?)\w+:(\w)", "$1$2")


def rss_items(feeds: DataFrame, most: int = 25) -> DataFrame:
    """feed_url, ord, url, title, snippet, published: the first items of each feed (columns feed_url, xml)."""
    doc = plain_xml(F.col("xml"))
    one = F.regexp_extract_all(doc, F.lit(r"(?s)<item\b.*?</item>"), F.lit(0))
    rows = feeds.select("feed_url", F.posexplode(F.slice(one, 1, most)).alias("ord", "item"))
    get = lambda f: normalize_space(F.xpath_string(F.col("item"), F.lit(f"item/{f}")))
    return rows.select("feed_url", "ord", get("link").alias("url"), get("title").alias("title"), get("description").alias("snippet"), get("pubDate").alias("published"))


def rss_candidates(feeds: DataFrame, cfg: Config, most: int = 25) -> DataFrame:
    """Items as candidates, four more than their score, the best of each link."""
    rows = rss_items(feeds, most).where(F.col("url") != "")
    score = L.candidate_score("title", "url", "snippet", cfg) + 4
    rows = rows.select(U.normalize_url("url").alias("url"), F.col("feed_url").alias("listing_url"), F.col("title").alias("title_hint"), F.col("snippet").alias("snippet_hint"), parse_iso("published").alias("published_hint"), F.lit("rss").alias("method"), score.alias("score"), "ord")
    from ..operators.ranking import best_by

    return best_by(rows, ["url"], [F.col("score"), -F.col("ord")])


def sitemap_entries(maps: DataFrame) -> DataFrame:
    """map_url, kind (index or urlset), loc, lastmod of fetched sitemaps (columns map_url, xml)."""
    doc = plain_xml(F.col("xml"))
    entries = F.regexp_extract_all(doc, F.lit(r"(?s)<(?:url|sitemap)>.*?</(?:url|sitemap)>"), F.lit(0))
    rows = maps.select("map_url", F.posexplode(entries).alias("ord", "entry"))
    get = lambda f: normalize_space(F.xpath_string(F.col("entry"), F.lit(f"*/{f}")))
    return rows.select("map_url", "ord", F.when(F.startswith("entry", F.lit("<sitemap>")), "index").otherwise("urlset").alias("kind"), get("loc").alias("loc"), get("lastmod").alias("lastmod"))


def sitemap_urls(maps: DataFrame, roots: DataFrame, depth: int = 3, most_maps: int = 12, most_urls: int = 600) -> DataFrame:
    """Page urls of each source reached from its root maps through indexes: its first maps and urls, in order of depth and place.

    roots: map_url, and source_name if there are several sources. Each step is a join with the fetched maps; the limits are a source's budget.
    """
    from ..operators.ranking import top_per

    entries = sitemap_entries(maps)
    front = roots.withColumn("source_name", F.col("source_name") if "source_name" in roots.columns else F.lit("")).select("source_name", "map_url").distinct()
    seen = front.withColumn("depth", F.lit(0))
    for step in range(1, depth + 1):
        found = entries.where("kind = 'index'").join(front, "map_url").select("source_name", F.col("loc").alias("map_url")).distinct().join(seen, ["source_name", "map_url"], "left_anti")
        seen = seen.unionByName(found.withColumn("depth", F.lit(step)))
        front = found
    used = top_per(seen, ["source_name"], [F.col("depth"), F.col("map_url")], most_maps, "turn")
    urls = entries.where("kind = 'urlset'").join(used, "map_url")
    return top_per(urls, ["source_name"], [F.col("depth"), F.col("map_url"), F.col("ord")], most_urls, "turn_url").select("source_name", F.col("loc").alias("url"), "lastmod", "map_url", "ord")


def sitemap_candidates(urls: DataFrame, cfg: Config) -> DataFrame:
    score = L.candidate_score(F.lit(""), F.col("url"), F.lit(""), cfg) + 2
    return urls.select(U.normalize_url("url").alias("url"), F.col("map_url").alias("listing_url"), F.lit("").alias("title_hint"), F.lit("").alias("snippet_hint"), parse_iso("lastmod").alias("published_hint"), F.lit("sitemap").alias("method"), score.alias("score"), "ord")


def guessed_maps(seeds: DataFrame) -> DataFrame:
    root = F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    return seeds.select(F.explode(F.transform(F.array(*[F.lit(p) for p in SITEMAP_PATHS]), lambda p: F.concat(root, p))).alias("map_url")).distinct()


def binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)


def pdf_texts(files: DataFrame, most_pages: int = 20) -> DataFrame:
    """path, body of PDF files; needs the optional package pypdf on the executors."""
    import pandas as pd

    from ..functions.html import pdf_post

    @F.pandas_udf("string")
    def read(content: pd.Series) -> pd.Series:
        import io

        import pypdf

        return content.map(lambda b: "\n".join(p.extract_text() or "" for p in pypdf.PdfReader(io.BytesIO(b)).pages[:most_pages]))

    return files.select("path", pdf_post(read("content")).alias("body"))
