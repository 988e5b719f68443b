"""HTML columns. What a pattern can read is native; what needs a parser is one Arrow function per kind."""

from __future__ import annotations

import html as entities
import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from .text import any_of, first_nonempty, let, normalize_space, text

# Types are spelt out: a worker that imports this module has no session to parse them with.
JSONLD = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "author", "published", "url", "body")])
METRICS = T.StructType([T.StructField("narrative_chars", T.IntegerType()), T.StructField("narrative_paragraphs", T.IntegerType()), T.StructField("table_density", T.DoubleType())])

#: Elements whose text nobody reads.
SILENT = ("script", "style", "noscript", "template")


def without_noise(html) -> Column:
    """Without comments, scripts and styles."""
    return F.regexp_replace(F.regexp_replace(text(html), r"(?s)<!--.*?-->", " "), r"(?is)<(script|style|noscript|template)\b.*?</\1\s*>", " ")


def strip_tags(html) -> Column:
    return normalize_space(F.regexp_replace(html, "<[^>]*>", " "))


def title_tag(html) -> Column:
    return normalize_space(F.regexp_extract(text(html), "<title>([^<]*)</title>", 1))


def article_text(html) -> Column:
    return strip_tags(F.regexp_extract(text(html), "(?s)<article>(.*)</article>", 1))


def visible_text(html) -> Column:
    return strip_tags(without_noise(html))


def meta_content(html, *names: str) -> Column:
    """Content of the first meta element with one of the names, in the order of names."""
    found = []
    for n in names:
        found += [F.regexp_extract(text(html), rf"(?is)<meta[^>]+(?:property|name)=[\"']{n}[\"'][^>]+content=[\"']([^\"']*)[\"']", 1), F.regexp_extract(text(html), rf"(?is)<meta[^>]+content=[\"']([^\"']*)[\"'][^>]+(?:property|name)=[\"']{n}[\"']", 1)]
    return first_nonempty(*found)


def jsonld_blocks(html) -> Column:
    return F.regexp_extract_all(text(html), F.lit(r"(?is)<script[^>]+application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))


@F.pandas_udf(JSONLD)
def jsonld_fields(blocks: pd.Series) -> pd.DataFrame:
    """First title, author, date and url, and longest body, of all objects in JSON-LD blocks."""

    def walk(raw) -> dict:
        out = dict.fromkeys(("title", "author", "published", "url", "body"), "")
        stack = []
        for b in raw if raw is not None else ():
            try:
                stack.append(json.loads(b))
            except ValueError:
                continue
        stack.reverse()
        while stack:
            x = stack.pop()
            if isinstance(x, list):
                stack.extend(reversed(x))
            elif isinstance(x, dict):
                author = x.get("author")
                author = author[0] if isinstance(author, list) and author else author
                author = author.get("name") if isinstance(author, dict) else author
                for k, v in (("title", x.get("headline") or x.get("name")), ("author", author), ("published", x.get("datePublished") or x.get("dateCreated") or x.get("dateModified")), ("url", x.get("url"))):
                    if not out[k] and isinstance(v, str):
                        out[k] = " ".join(v.split())
                body = x.get("articleBody")
                if isinstance(body, str) and len(body) > len(out["body"]):
                    out["body"] = " ".join(body.split())
                if isinstance(x.get("@graph"), list):
                    stack.extend(reversed(x["@graph"]))
        return out

    return pd.DataFrame([walk(b) for b in blocks], columns=["title", "author", "published", "url", "body"])


@F.pandas_udf(T.ArrayType(T.StringType()))
def jsonld_dates(blocks: pd.Series) -> pd.Series:
    """Dates of publication and of change of all objects in JSON-LD blocks; of a list the last object first."""

    def walk(raw) -> list:
        out = []
        for b in raw if raw is not None else ():
            try:
                stack = [json.loads(b)]
            except ValueError:
                continue
            while stack:
                x = stack.pop()
                if isinstance(x, list):
                    stack.extend(x)
                elif isinstance(x, dict):
                    if "@graph" in x:
                        stack.append(x["@graph"])
                    out += [" ".join(v.split()) for k in ("datePublished", "dateModified") if isinstance(v := x.get(k), str) and v.strip()]
        return out

    return blocks.map(walk)


#: Text of mere numbers (fixed value).
NUMBERS = re.compile(r"[\d\s,.\-+/%:$]+")


class _Reader(HTMLParser):
    """Paragraph and item texts outside tables, table texts, all visible text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.silent = self.tables = 0
        self.open: list[tuple[str, list[str]]] = []
        self.blocks: list[str] = []
        self.nodes: list[list[str]] = []
        self.stack: list[tuple[str, int]] = []
        self.visible: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent += 1
            return
        if tag in ("table", "li") and self.open and self.open[-1][0] == "p":  # these end a paragraph that was left open
            self.close_last()
        if tag in ("table", "tr", "td", "th"):
            self.tables += tag == "table"
            self.nodes.append([])
            self.stack.append((tag, len(self.nodes) - 1))
        elif tag in ("p", "li") and not self.tables:
            if self.open and self.open[-1][0] == tag:  # a paragraph or item ends where the next begins
                self.close_last()
            self.open.append((tag, []))

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in ("table", "tr", "td", "th"):
            self.tables = max(0, self.tables - (tag == "table"))
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == tag:
                    del self.stack[i:]
                    break
        elif tag in ("p", "li") and any(t == tag for t, _ in self.open):
            while self.open[-1][0] != tag:
                self.close_last()
            self.close_last()

    def handle_data(self, data):
        if self.silent:
            return
        self.visible.append(data)
        for _, i in self.stack:
            self.nodes[i].append(data)
        if not self.tables:
            for _, told in self.open:
                told.append(data)

    def close_last(self):
        self.blocks.append(" ".join(" ".join(self.open.pop()[1]).split()))


@F.pandas_udf(METRICS)
def narrative_metrics(html: pd.Series) -> pd.DataFrame:
    """Characters and number of paragraphs and items of 40 characters and more outside tables that aren't mere numbers, one inside another counting again, and the share
    of table text (of nested table nodes again) in all text."""
    out = []
    for raw in html:
        r = _Reader()
        r.feed(raw or "")
        r.close()
        while r.open:
            r.close_last()
        told = [b for b in r.blocks if len(b) >= 40 and not NUMBERS.fullmatch(b)]
        tables = len(" ".join(" ".join(" ".join(n).split()) for n in r.nodes))
        seen = len(" ".join(" ".join(r.visible).split()))
        out.append((sum(map(len, told)), len(told), round(min(1.0, tables / seen), 3) if seen else 0.0))
    return pd.DataFrame(out, columns=["narrative_chars", "narrative_paragraphs", "table_density"])


@F.pandas_udf(T.StringType())
def unescape(x: pd.Series) -> pd.Series:
    return x.map(lambda v: entities.unescape(v or ""))


def page_title(html) -> Column:
    """Title by JSON-LD, then meta, then heading, then title element."""
    return first_nonempty(jsonld_fields(jsonld_blocks(html))["title"], meta_content(html, "og:title", "twitter:title", "headline"), heading(html), title_tag(html))


def heading(html) -> Column:
    return strip_tags(F.regexp_extract(text(html), r"(?is)<h1\b[^>]*>(.*?)</h1>", 1))


def block_page(html) -> Column:
    return any_of(F.lower(normalize_space(html)), C.BLOCK_PHRASES)


def decode_bytes(data, charset: str | None) -> Column:
    """Bytes as text: by the header's charset if it is known and fits, else UTF-8, else Latin-1, which every byte fits."""
    known = F.lit(None).cast("string") if not charset or charset.upper() not in ("US-ASCII", "ISO-8859-1", "UTF-8", "UTF-16BE", "UTF-16LE", "UTF-16", "UTF-32") else charset.upper()
    data = F.col(data) if isinstance(data, str) else data
    utf8 = F.when(F.is_valid_utf8(data.cast("string")), data.cast("string"))
    latin = F.decode(data, F.lit("ISO-8859-1"))
    if isinstance(known, str) and known not in ("UTF-8", "US-ASCII"):
        return F.decode(data, F.lit(known))
    return F.coalesce(utf8, latin)


def pdf_post(x) -> Column:
    """Text of a PDF without hyphens at line ends, with single spaces and no more than one empty line."""
    joined = F.regexp_replace(text(x), r"(\w)-\n(\w)", "$1$2")
    return F.trim(F.regexp_replace(F.regexp_replace(joined, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def quote_signal(title, body, url) -> Column:
    """struct(signal, reasons, score): how much a page is a table of quotes."""
    from .url import normalize_url

    t, low_url = F.lower(normalize_space(title)), F.lower(normalize_url(url))
    return let(F.lower(F.concat_ws(" ", text(title), text(body), text(url))), lambda x: _quote_points(x, t, low_url))


def _quote_points(x: Column, t: Column, low_url: Column) -> Column:
    count = lambda p: F.regexp_count(x, F.lit(p))
    price = r"\bprice of .+ today\b|\bfutures prices\b|\bper ton today\b"
    points = [
        (any_of(low_url, C.QUOTE_URLS), 4, "price_url_pattern"),
        (F.regexp_like(x, F.lit(price + r"|\b3m\b|\bcash\b")), 3, "price_title_pattern"),
        (F.regexp_like(t, F.lit(price + r"|\blmeselect\b|\bshfe\b|\bcomex\b")), 3, "exchange_title_pattern"),
        (any_of(x, ("lme", "shfe", "comex")) & any_of(x, ("3m", "cash", "settlement", "open interest", "contract")), 3, "contract_quote_terms"),
        (count(r"\b[a-z]{1,3}\d{1,4}\b") >= 3, 2, "contract_codes"),
        (count(r"\b(?:cash|3m|bid|ask|open|high|low|volume|change)\b") >= 6, 2, "ticker_table_terms"),
    ]
    score = sum((F.when(hit, n).otherwise(0) for hit, n, _ in points), F.lit(0))
    reasons = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for hit, _, name in points]))
    return let(score, lambda s: F.struct(F.when(s >= 6, "high").when(s >= 3, "medium").otherwise("low").alias("signal"), reasons.alias("reasons"), s.alias("score")))
