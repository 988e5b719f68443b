"""URL columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import BAD_PATHS, REPORT_PATHS, SECTION_WORDS
from .text import any_of, text

#: Query keys that tell pages of a listing apart; paths without content (fixed values).
PAGE_KEYS = ("page", "p", "pg", "offset", "start", "skip", "cursor", "articlepage")
NON_CONTENT = ("/login", "/register", "/signup", "/sign-in", "/contact", "/about", "/privacy", "/terms", "/careers", "/download", "/downloads", "/app", "/apps", "/podcast", "/podcasts", "/video", "/videos")
DATED = r"/(20\d{2})/(\d{1,2})/(\d{1,2})/"


def normalize_url(url) -> Column:
    """Without query, fragment and closing slashes."""
    return F.regexp_replace(F.regexp_replace(text(url), "[?#].*$", ""), "/+$", "")


def host_of(url) -> Column:
    """Lower-case host without user and port."""
    return F.lower(F.regexp_extract(text(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path_of(url) -> Column:
    return F.lower(F.regexp_extract(text(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1))


def scheme_of(url) -> Column:
    return F.lower(F.regexp_extract(text(url), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def listing_url(url) -> Column:
    """Without fragment, and of the query only what tells pages apart; empty if it isn't http(s)."""
    query = F.regexp_extract(text(url), r"\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda kv: F.lower(F.substring_index(kv, "=", 1)).isin(*PAGE_KEYS))
    tail = F.array_join(kept, "&")
    bare = F.regexp_replace(F.concat(F.regexp_replace(text(url), "[?#].*$", ""), F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise("")), "/+$", "")
    return F.when(scheme_of(url).isin("http", "https"), bare).otherwise("")


def looks_like_article(url) -> Column:
    path = F.regexp_replace(path_of(url), "/+$", "")
    return scheme_of(url).isin("http", "https") & (path != "") & ~any_of(path, BAD_PATHS)


def looks_like_pdf(url) -> Column:
    return F.endswith(path_of(url), F.lit(".pdf"))


def looks_like_report(url) -> Column:
    return any_of(path_of(url), REPORT_PATHS)


def url_date(url) -> Column:
    """The date in the path, if there is a valid one."""
    part = lambda i: F.regexp_extract(text(url), DATED, i)
    return F.when(F.regexp_like(text(url), F.lit(DATED)), F.to_date(F.try_to_timestamp(F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")), F.lit("yyyy-MM-dd"))))


def section_page(url) -> Column:
    parts = F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    return (F.size(parts) == 0) | ((F.size(parts) <= 2) & F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit("")).isin(*SECTION_WORDS))


def same_day_url(url, target_date: str) -> Column:
    return F.coalesce(url_date(url) == F.lit(target_date).cast("date"), F.lit(False))


def old_archive(url, target_date: str, archive_hosts: tuple[str, ...] = ("reuters.com",)) -> Column:
    """Dated, not on the day, and either in an archive, on a host that keeps old pages, or before the day."""
    day, target = url_date(url), F.lit(target_date).cast("date")
    kept = F.contains(F.lower(normalize_url(url)), F.lit("/archive/")) | any_of(host_of(url), archive_hosts)
    return F.coalesce((day != target) & (kept | (day < target)), F.lit(False))


def allowed_host(url, hosts: Column) -> Column:
    """The host is listed or under one that is; an empty list allows all."""
    h = host_of(url)
    return (F.size(hosts) == 0) | F.exists(hosts, lambda a: (h == a) | F.endswith(h, F.concat(F.lit("."), a)))


def allowed_or_seed_host(url, hosts: Column, seeds: Column) -> Column:
    return allowed_host(url, F.when(F.size(hosts) > 0, hosts).otherwise(F.transform(seeds, host_of)))


def host_suffixes(url) -> Column:
    """a.b.c, b.c, c: for an equi-join in the place of a suffix test."""
    parts = F.split(host_of(url), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def non_content(url) -> Column:
    return any_of(F.lower(normalize_url(url)), NON_CONTENT)


def pagination_link(url, anchor) -> Column:
    """By a page number in the whole url, or by a word in url or anchor."""
    both = F.lower(F.concat_ws(" ", text(url), text(anchor)))
    return any_of(both, ("?page=", "&page=", "/page/", "next", "older", "more")) | F.regexp_like(both, F.lit(r"[?&](?:p|pg|page)=\d+"))


def inferred_hosts(urls: Column) -> Column:
    """Hosts of the urls, each with and without www."""
    bare = F.array_distinct(F.filter(F.transform(urls, lambda u: F.regexp_replace(host_of(u), r"^www\.", "")), lambda h: h != ""))
    return F.flatten(F.transform(bare, lambda h: F.array(h, F.concat(F.lit("www."), h))))


def env_name(name) -> Column:
    return F.concat(F.trim(F.regexp_replace(F.upper(text(name)), "[^A-Z0-9]+", "_"), F.lit("_")), F.lit("_URL"))


def join_url(base, href) -> Column:
    """href against base: absolute, from the root, or beside the page."""
    href = text(href)
    root = F.regexp_extract(text(base), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    return (
        F.when(F.regexp_like(href, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme_of(base), F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, href))
        .otherwise(F.concat(F.regexp_replace(F.regexp_replace(text(base), "[?#].*$", ""), "(?<=[^/:])/[^/]*$", ""), F.lit("/"), href))
    )
