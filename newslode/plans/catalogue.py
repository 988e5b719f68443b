"""Queries over the given tables, each with its SQL where SQL can say it.

The tables hold invented words, so the queries use the lexicon that was made for them.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE, Config
from ..functions import dates as T
from ..functions import dom as N
from ..functions import html as H
from ..functions import lexicon as L
from ..functions import text as X
from ..functions import url as U
from ..operators import acceptance as A
from ..operators import discovery as D
from ..operators import ranking as R
from ..operators import sinks
from ..operators import summary as S
from ..sources import registry
from ..streaming import audit

CFG = Config(lexicon=FIXTURE)
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, title, body, norm_url of the pages."""
    return table(spark, sf_dir, "pages").select("page_id", "url", H.title_tag("html").alias("title"), H.article_text("html").alias("body"), U.normalize_url("url").alias("norm_url"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, title (first line), body (the rest) of the documents."""
    x = X.text("text")
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.substring_index(x, "\n", 1).alias("title"), F.when(F.contains(x, F.lit("\n")), F.expr("substring(coalesce(text, ''), instr(coalesce(text, ''), '\n') + 1)")).otherwise("").alias("body"))


# --- SQL parts -------------------------------------------------------------------------------------------------------


def q(t: str) -> str:
    return "'" + t.replace("'", "''") + "'"


def s_sum(x: str, terms, points: int = 1) -> str:
    return "(" + " + ".join(f"CASE WHEN contains({x}, {q(t)}) THEN {points} ELSE 0 END" for t in terms) + ")" if terms else "0"


def s_any(x: str, terms) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(t)})" for t in terms) + ")" if terms else "false"


def s_space(x: str) -> str:
    return rf"trim(regexp_replace(coalesce({x}, ''), '\s+', ' ', 'g'))"


def s_norm(u: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({u}, ''), '[?#].*$', ''), '/+$', '')"


def s_host(u: str) -> str:
    return rf"lower(regexp_extract(coalesce({u}, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"


def s_path(u: str) -> str:
    return rf"lower(regexp_extract(coalesce({u}, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1))"


def s_relevance(t: str, b: str, lex=FIXTURE) -> str:
    t, b = f"lower({t})", f"lower({b})"
    both = f"({t} || chr(10) || {b})"
    return f"({s_sum(t, lex.primary, 5)} + {s_sum(b, lex.primary, 3)} + {s_sum(t, lex.broad, 3)} + {s_sum(b, lex.broad, 2)} + {s_sum(both, lex.analysis)} - {s_sum(both, lex.negative, 5)})"


def s_scope(blob: str, lex=FIXTURE) -> str:
    (_, wa), (_, wb) = list(lex.targets.items())
    a, b = s_any(blob, wa), s_any(blob, wb)
    return f"CASE WHEN {a} AND {b} THEN 'Copper, Aluminum' WHEN {a} THEN 'Copper' WHEN {b} THEN 'Aluminum' WHEN {s_any(blob, lex.broad)} THEN 'Broad Metals' ELSE 'Unknown' END"


# A word's edge as Java has it: letters of any script belong to words.
EDGE = r"(^|[^\p{{L}}\p{{Nd}}_])({0})($|[^\p{{L}}\p{{Nd}}_])"


def s_target(x: str, lex=FIXTURE) -> str:
    return "(" + " OR ".join(f"regexp_matches({x}, {q(EDGE.format(w))})" for w in lex.primary) + ")"


def s_day(u: str) -> str:
    part = lambda i: rf"regexp_extract({u}, '/(20\d{{2}})/(\d{{1,2}})/(\d{{1,2}})/', {i})"
    return f"TRY_CAST({part(1)} || '-' || lpad({part(2)}, 2, '0') || '-' || lpad({part(3)}, 2, '0') AS DATE)"


def s_section_page(u: str) -> str:
    parts = f"list_filter(string_split({s_path(u)}, '/'), lambda p: p <> '')"
    return f"(len({parts}) <= 2 AND coalesce({parts}[-1], 'news') IN ({', '.join(q(w) for w in U.SECTION_WORDS)}))"


PAGES = rf"""
pages_t AS (
    SELECT page_id, url, {s_space("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title,
           {s_space("regexp_replace(regexp_extract(html, '<article>((?s:.)*)</article>', 1), '<[^>]*>', ' ', 'g')")} AS body, {s_norm("url")} AS norm_url
    FROM pages
)"""
DOCS = r"""
docs_t AS (
    SELECT doc_id, source, lang, split_part(coalesce(text, ''), chr(10), 1) AS title,
           CASE WHEN contains(text, chr(10)) THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS body
    FROM documents
)"""
LINKS = rf"""
links_t AS (
    SELECT url AS listing_url, i - 1 AS ord, regexp_extract(a[i], '<a href="([^"]*)">', 1) AS href, {s_space("regexp_extract(a[i], '>([^<]*)</a>', 1)")} AS anchor
    FROM (SELECT url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>') AS a FROM pages), unnest(generate_series(1, len(a))) AS s(i)
), links_u AS (
    SELECT listing_url, ord, anchor, regexp_extract(listing_url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href AS url FROM links_t
)"""


# --- URL and text ----------------------------------------------------------------------------------------------------


@query(rf"""
SELECT page_id, {s_norm("url")} AS norm_url, {s_host("url")} AS host,
       (len(parts) = 0 OR (len(parts) <= 2 AND parts[-1] IN ({", ".join(q(w) for w in U.SECTION_WORDS)}))) AS is_section
FROM (SELECT *, list_filter(string_split({s_path("url")}, '/'), lambda p: p <> '') AS parts FROM pages)""")
def url_normalize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.normalize_url("url").alias("norm_url"), U.host_of("url").alias("host"), U.section_page("url").alias("is_section"))


@query(rf"""
SELECT page_id, regexp_matches(url, '^https?:') AND rtrim(p, '/') <> '' AND NOT {s_any("rtrim(p, '/')", U.BAD_PATHS)} AS is_article,
       suffix(p, '.pdf') AS is_pdf, {s_any("p", U.REPORT_PATHS)} AS is_report, {s_any(f"lower({s_norm('url')})", U.NON_CONTENT)} AS is_non_content
FROM (SELECT *, {s_path("url")} AS p FROM pages)""")
def url_article_filter(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.looks_like_article("url").alias("is_article"), U.looks_like_pdf("url").alias("is_pdf"), U.looks_like_report("url").alias("is_report"), U.non_content("url").alias("is_non_content"))


@query(rf"""
SELECT listing_url, count(*) AS n FROM (
    SELECT rtrim(regexp_replace(url, '[?#].*$', '') || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END, '/') AS listing_url
    FROM (SELECT url, list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda kv: lower(split_part(kv, '=', 1)) IN ({", ".join(q(k) for k in U.PAGE_KEYS)})) AS kept FROM pages)
) GROUP BY 1""")
def url_listing_key(spark, sf_dir):
    return table(spark, sf_dir, "pages").groupBy(U.listing_url("url").alias("listing_url")).agg(F.count("*").alias("n"))


@query(rf"""
SELECT doc_id, length({s_space("text")}) AS n_clean,
       CASE WHEN length({s_space("text")}) <= 80 THEN {s_space("text")} ELSE rtrim(CASE WHEN contains(left({s_space("text")}, 80), ' ') THEN regexp_replace(left({s_space("text")}, 80), ' [^ ]*$', '') ELSE left({s_space("text")}, 80) END) || '...' END AS teaser,
       CASE WHEN length(text) <= 60 THEN text ELSE regexp_replace(left(text, 60), '\s+$', '') || '...' END AS cut
FROM documents WHERE text IS NOT NULL""")
def text_normalize(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.length(X.normalize_space("text")).alias("n_clean"), X.truncate_text("text", 80).alias("teaser"), X.truncate("text", 60).alias("cut"))


@query(rf"""
SELECT doc_id, len(s) AS n_sentences, coalesce(s[1], '') AS first_sentence FROM (
    SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: {s_space("x")}), lambda x: x <> '') AS s FROM documents)""")
def text_sentences(spark, sf_dir):
    s = X.sentences("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(s).alias("n_sentences"), F.coalesce(F.get(s, F.lit(0)), F.lit("")).alias("first_sentence"))


@query("""SELECT doc_id, left(sha256(lower(trim(coalesce(source, ''))) || '||' || lower(trim(coalesce(lang, ''))) || '||' || lower(trim(CAST(doc_id AS VARCHAR)))), 40) AS unique_key FROM documents""")
def unique_key(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.stable_key("source", "lang", "doc_id").alias("unique_key"))


@query(rf"""WITH {DOCS} SELECT doc_id, len(p) AS n_points, coalesce(p[1], '') AS first_point FROM (
    SELECT doc_id, list_filter(list_distinct_kept, lambda x: x <> '') AS p FROM (
        SELECT doc_id, list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform(list_transform(string_split(trim(body), chr(10)), lambda x: {s_space("regexp_replace(x, '^[-*•· ]+', '')")}), lambda x: [x])), lambda a, b: CASE WHEN list_contains(a, b[1]) OR b[1] = '' THEN a ELSE list_concat(a, b) END) AS list_distinct_kept FROM docs_t))
    WHERE len(p) > 0""")
def structured_points(spark, sf_dir):
    p = X.structured_points("body")
    return docs(spark, sf_dir).select("doc_id", F.size(p).alias("n_points"), F.coalesce(F.get(p, F.lit(0)), F.lit("")).alias("first_point")).where("n_points > 0")


def s_merge(step: str) -> str:
    blocks = f"list_filter([{s_space('title')}, {s_space('body')}, {s_space('split_part(body, chr(10), 1)')}], lambda v: v <> '')"
    joined = f"array_to_string(list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform({blocks}, lambda v: [v])), lambda a, b: {step}), chr(10) || chr(10))"
    return f"length(CASE WHEN length({joined}) <= 16000 THEN {joined} ELSE trim(regexp_replace(left({joined}, 16000), ' [^ ]*$', '')) END)"


_INSIDE, _HOLDS = "contains(lower(k), lower(b[1]))", "contains(lower(b[1]), lower(k))"


@query(rf"""WITH {DOCS} SELECT doc_id, {s_merge(f"CASE WHEN len(list_filter(a, lambda k: {_INSIDE} OR {_HOLDS})) > 0 THEN a ELSE list_concat(a, b) END")} AS first_wins,
    {s_merge(f"CASE WHEN len(list_filter(a, lambda k: {_INSIDE})) > 0 THEN a ELSE list_concat(list_filter(a, lambda k: NOT {_HOLDS}), b) END")} AS longest_wins FROM docs_t""")
def merged_blocks(spark, sf_dir):
    """Both ways of merging title, body and first paragraph."""
    rows = docs(spark, sf_dir)
    return rows.select("doc_id", F.length(X.merge_blocks("title", "body", F.substring_index("body", "\n", 1), mode="first_wins")).alias("first_wins"), F.length(X.merge_blocks("title", "body", F.substring_index("body", "\n", 1))).alias("longest_wins"))


@query(r"""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00+00:00' END AS published_at,
       CASE WHEN o_orderkey % 7 = 0 THEN 999 ELSE abs(date_diff('day', DATE '1995-06-17', CAST(o_orderdate AS DATE))) END AS days
FROM orders""")
def date_parse(spark, sf_dir):
    """Dates written in four forms, and one that is none, read back."""
    d = F.col("o_orderdate")
    k = F.col("o_orderkey") % 7
    raw = F.when(k == 0, "March 2026").when(k <= 2, F.date_format(d, "yyyy-MM-dd")).when(k <= 4, F.date_format(d, "MMMM d, yyyy")).otherwise(F.date_format(d, "d MMM yyyy"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", T.parse_iso(raw).alias("published_at"))
    return rows.withColumn("days", T.days_from("published_at", "1995-06-17"))


# --- Lexicon scores --------------------------------------------------------------------------------------------------


@query(rf"""WITH {PAGES}, scored AS (SELECT *, {s_relevance("title", "body")} AS score FROM pages_t)
SELECT norm_url, arg_max(page_id, CAST(score AS BIGINT) * 1000000000 - page_id) AS page_id, arg_max(title, CAST(score AS BIGINT) * 1000000000 - page_id) AS title, max(score) AS score
FROM scored WHERE score > 0 GROUP BY norm_url ORDER BY score DESC, norm_url LIMIT 200""")
def pages_relevance_topk(spark, sf_dir):
    """Flagship: the most relevant pages, one of each normalised url."""
    rows = pages(spark, sf_dir).withColumn("score", L.relevance("title", "body", FIXTURE)).where("score > 0")
    best = R.dedupe_by_url(rows, "norm_url", "score", "page_id")
    return best.select("norm_url", "page_id", "title", "score").orderBy(F.col("score").desc(), "norm_url").limit(200)


@query(rf"""WITH {DOCS} SELECT doc_id, {s_relevance("title", "body")} AS score,
    {s_sum("lower(title)", FIXTURE.direct, 4)} + {s_sum("lower(body)", FIXTURE.direct, 2)} + {s_sum("lower(title || chr(10) || body)", FIXTURE.analysis)} - {s_sum("lower(title || chr(10) || body)", FIXTURE.negative, 5)} AS legacy_score FROM docs_t""")
def doc_relevance_score(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", L.relevance("title", "body", FIXTURE).alias("score"), L.relevance_legacy("title", "body", FIXTURE).alias("legacy_score"))


@query(rf"""WITH {DOCS} SELECT scope, count(*) AS n, count_if(named) AS n_named FROM (
    SELECT {s_scope("lower(title || chr(10) || body)")} AS scope, {s_target("lower(title || chr(10) || body)")} AS named FROM docs_t) GROUP BY scope""")
def doc_scope(spark, sf_dir):
    named = L.has_target(F.concat("title", F.lit("\n"), "body"), FIXTURE)
    return docs(spark, sf_dir).select(L.scope("title", "body", FIXTURE).alias("scope"), named.alias("named")).groupBy("scope").agg(F.count("*").alias("n"), F.count_if("named").alias("n_named"))


@query(rf"""WITH {DOCS} SELECT doc_id, c AS has_context, c AND t AS strong FROM (
    SELECT doc_id, {s_any(f"lower({s_space('body')})", FIXTURE.intelligence + FIXTURE.structure)} AS c, {s_target(f"lower({s_space('body')})")} AS t FROM docs_t)""")
def doc_market_context(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", L.market_context("body", FIXTURE).alias("has_context"), L.strong_signal("body", FIXTURE).alias("strong"))


BULL, BEAR = ("the", "eren"), ("and", "tion", "wh")
RULES = ((("thble", "ndin"), "Supply outlook"), (("erti", "eaux"), "Demand outlook"), (("sch",), "Trade and policy"))


@query(rf"""WITH {DOCS} SELECT doc_id, CASE WHEN u > d THEN 'Bullish' WHEN d > u THEN 'Bearish' WHEN u > 0 THEN 'Mixed' ELSE 'Neutral' END AS stance, theme, section FROM (
    SELECT doc_id, {s_sum("lower(body)", BULL)} AS u, {s_sum("lower(body)", BEAR)} AS d,
        CASE {" ".join(f"WHEN {s_any('lower(title || chr(32) || body)', t)} THEN {q(n)}" for t, n in RULES)} ELSE 'General market commentary' END AS theme,
        CASE WHEN {s_any("lower(body)", L.C.DIGEST_INVENTORY)} THEN 'inventory' WHEN {s_any("lower(body)", L.C.DIGEST_PRICE)} THEN 'price' WHEN {s_any("lower(body)", L.C.DIGEST_OUTLOOK)} THEN 'outlook' ELSE 'drivers' END AS section FROM docs_t)""")
def doc_stance_theme(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", L.stance("body", BULL, BEAR).alias("stance"), L.theme("title", "body", RULES).alias("theme"), L.digest_section("body", F.lit(""), F.lit("")).alias("section"))


_CONTEXT = FIXTURE.intelligence + FIXTURE.structure


@query(rf"""WITH {DOCS}, t_t AS (SELECT *, {s_space("title")} AS t, {s_space("body")} AS b, {s_scope("lower(title || chr(10) || body)")} AS scope, lower(title || chr(10) || body || chr(10)) AS blob FROM docs_t),
h_t AS (SELECT *, t || chr(10) AS head, t || chr(10) || chr(10) || b AS whole FROM t_t),
f_t AS (SELECT *, {s_any("lower(head)", _CONTEXT)} AS context_head, {s_any("lower(whole)", _CONTEXT)} AS context_all, {s_target("lower(head)")} AS target_head, {s_target("lower(whole)")} AS target_all, {s_any("lower(whole)", FIXTURE.company)} AS company,
    {s_any("lower(head)", FIXTURE.priority)} AS priority, {s_relevance("t", "''")} >= {CFG.topic_threshold} AS head_ok, {s_relevance("t", "chr(10) || b")} >= 3 AS all_ok, scope IN ('Copper', 'Aluminum', 'Copper, Aluminum') AS scoped,
    {s_sum("lower(title)", FIXTURE.direct, 4)} + {s_sum("lower(body)", FIXTURE.direct, 2)} + {s_sum("lower(title || chr(10) || body)", FIXTURE.analysis)} - {s_sum("lower(title || chr(10) || body)", FIXTURE.negative, 5)} AS legacy FROM h_t)
SELECT doc_id, target_all AND NOT (company AND NOT ((target_head AND context_head) OR context_all)) AND ((context_head AND head_ok) OR (scoped AND all_ok) OR (context_all AND all_ok) OR (target_head AND priority AND head_ok)) AS topic,
    {s_target("blob")} AND ({s_any("blob", _CONTEXT)} OR (length(body) >= {CFG.rescue_body_chars} AND {s_relevance("title", "body")} >= {CFG.rescue_score})) AS content,
    CASE WHEN scoped THEN legacy >= 3 WHEN scope = 'Broad Metals' THEN legacy >= 5 ELSE false END AS topic_legacy FROM f_t""")
def doc_topic_match(spark, sf_dir):
    rows = docs(spark, sf_dir).withColumn("scope", L.scope("title", "body", FIXTURE)).withColumn("hint", F.lit(""))
    return rows.select("doc_id", L.topic_matches("title", F.lit(""), "body", "hint", "scope", CFG).alias("topic"), L.content_matches("title", "body", F.lit(""), F.lit("html"), CFG).alias("content"), L.topic_matches_legacy("title", "body", "scope", FIXTURE).alias("topic_legacy"))


LATTICE = "CASE r WHEN 'All' THEN true WHEN 'Copper' THEN s IN ('Copper', 'Copper, Aluminum') WHEN 'Aluminum' THEN s IN ('Aluminum', 'Copper, Aluminum') WHEN 'Broad Metals' THEN s = 'Broad Metals' ELSE s IN ('Copper', 'Aluminum', 'Copper, Aluminum') END"


@query(rf"""WITH {DOCS}, scoped AS (SELECT {s_scope("lower(title || chr(10) || body)")} AS s FROM docs_t),
asked AS (SELECT * FROM (VALUES ('All'), ('Copper'), ('Aluminum'), ('Broad Metals'), ('Copper, Aluminum')) AS v(r))
SELECT r AS requested, count_if({LATTICE}) AS n FROM scoped, asked GROUP BY r""")
def scope_lattice(spark, sf_dir):
    scoped = docs(spark, sf_dir).groupBy(L.scope("title", "body", FIXTURE).alias("scope")).agg(F.count("*").alias("m"))
    asked = F.explode(F.array(*[F.lit(a) for a in ("all", "copper", "aluminium", "broad-metals", "Copper, Aluminum")]))
    rows = scoped.select("scope", "m", asked.alias("raw")).withColumn("requested", L.normalize_scope("raw"))
    return rows.groupBy("requested").agg(F.sum(F.when(L.scope_matches("requested", "scope"), F.col("m")).otherwise(0)).alias("n"))


# --- Links and candidates --------------------------------------------------------------------------------------------


@query(rf"""WITH {LINKS} SELECT listing_url, ord, url, anchor FROM links_u""")
def page_links(spark, sf_dir):
    return D.links(table(spark, sf_dir, "pages"))


@query(None)
def page_links_parsed(spark, sf_dir):
    return D.parsed_links(table(spark, sf_dir, "pages")).select("listing_url", "ord", "url", "anchor", F.length("snippet").alias("n_snippet"))


def s_candidate(t: str, u: str) -> str:
    blob = f"lower({t} || '  ' || {u})"
    return rf"""(CASE WHEN {s_target(blob)} THEN 6 ELSE -4 END + {s_sum(blob, FIXTURE.analysis, 2)} + CASE WHEN {s_any(blob, FIXTURE.intelligence + FIXTURE.structure)} THEN 2 ELSE 0 END - {s_sum(blob, FIXTURE.negative, 5)}
    + CASE WHEN {s_any(s_path(u), U.REPORT_PATHS)} THEN 2 ELSE 0 END + CASE WHEN suffix({s_path(u)}, '.pdf') THEN -2 ELSE 1 END + CASE WHEN regexp_matches({u}, '/(20\d{{2}})/(\d{{1,2}})/(\d{{1,2}})/') THEN 2 ELSE 0 END
    - CASE WHEN len(list_filter(string_split({s_path(u)}, '/'), lambda p: p <> '')) <= 2 AND coalesce(list_filter(string_split({s_path(u)}, '/'), lambda p: p <> '')[-1], 'news') IN ({", ".join(q(w) for w in U.SECTION_WORDS)}) THEN 6 ELSE 0 END)"""


@query(rf"""WITH {LINKS} SELECT listing_url, ord, {s_candidate("anchor", "url")} AS score FROM links_u""")
def candidate_score(spark, sf_dir):
    return D.links(table(spark, sf_dir, "pages")).select("listing_url", "ord", L.candidate_score("anchor", "url", F.lit(""), CFG).alias("score"))


def link_candidates(spark, sf_dir) -> DataFrame:
    rows = D.links(table(spark, sf_dir, "pages")).withColumn("score", L.candidate_score("anchor", "url", F.lit(""), CFG))
    ord_ = F.concat_ws("#", "listing_url", F.lpad(F.col("ord").cast("string"), 6, "0"))
    return rows.select("url", "listing_url", F.col("anchor").alias("title_hint"), F.lit("").alias("snippet_hint"), F.lit("").alias("published_hint"), F.lit("listing").alias("method"), "score", F.xxhash64(ord_).alias("ord"), ord_.alias("ord_text"))


@query(rf"""WITH {LINKS}, c AS (SELECT url, anchor, {s_candidate("anchor", "url")} AS score FROM links_u)
SELECT url, max(score) AS score, max(length(anchor)) AS n_title, count(*) AS n FROM c GROUP BY url""")
def candidate_merge(spark, sf_dir):
    """The merged candidate of each url, with how many there were."""
    found = link_candidates(spark, sf_dir)
    merged = R.merge_candidates(found).select("url", "score", F.length("title_hint").alias("n_title"))
    return merged.join(found.groupBy("url").agg(F.count("*").alias("n")), "url")


@query(rf"""WITH {LINKS}, c AS (SELECT {s_host("url")} AS host, {s_candidate("anchor", "url")} AS score FROM links_u)
SELECT host, count(*) AS n, count_if(score >= 2) AS n_strong, count_if(score < 0) AS n_weak FROM c GROUP BY host""")
def method_counts(spark, sf_dir):
    rows = link_candidates(spark, sf_dir)
    return rows.groupBy(U.host_of("url").alias("host")).agg(F.count("*").alias("n"), F.count_if(F.col("score") >= 2).alias("n_strong"), F.count_if(F.col("score") < 0).alias("n_weak"))


@query(rf"""WITH {DOCS}, s AS (SELECT doc_id, source, {s_relevance("title", "body")} AS score FROM docs_t),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rank FROM s) SELECT source, rank, doc_id, score FROM r WHERE rank <= 10""")
def per_source_topk(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", "source", L.relevance("title", "body", FIXTURE).alias("score"))
    return R.top_per(rows, ["source"], [F.col("score").desc(), F.col("doc_id")], 10).select("source", "rank", "doc_id", "score")


@query(rf"""WITH {DOCS}, s AS (SELECT doc_id, source, {s_relevance("title", "body")} AS score, doc_id % 5 = 0 AS is_pdf FROM docs_t),
o AS (SELECT *, row_number() OVER w AS place, score >= 8 AS strong, coalesce(sum(CAST(score >= 8 AS INT)) OVER (PARTITION BY source ORDER BY is_pdf, score DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM s WINDOW w AS (PARTITION BY source ORDER BY is_pdf, score DESC, doc_id)),
k AS (SELECT *, row_number() OVER (PARTITION BY source, strong, is_pdf ORDER BY place) AS turn, sum(CAST(strong AND NOT is_pdf AS INT)) OVER (PARTITION BY source) AS html
      FROM o WHERE before < 12 AND (strong OR score >= 4)),
b AS (SELECT *, CASE WHEN strong AND NOT is_pdf AND turn <= 9 THEN 1 WHEN NOT strong AND NOT is_pdf THEN 2 WHEN strong AND is_pdf AND html < 9 THEN 3 WHEN NOT strong AND is_pdf THEN 4 END AS bucket FROM k),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY bucket, place) AS list_rank FROM b WHERE bucket IS NOT NULL)
SELECT source AS source_name, doc_id, bucket, list_rank, score FROM r WHERE list_rank <= 18""")
def shortlist(spark, sf_dir):
    rows = docs(spark, sf_dir).select(F.col("source").alias("source_name"), F.col("doc_id").cast("string").alias("url"), "doc_id", L.relevance("title", "body", FIXTURE).alias("score"), (F.col("doc_id") % 5 == 0).alias("is_pdf"), F.lit(False).alias("is_report"), F.col("doc_id").alias("ord"))
    return R.shortlist(rows, F.col("score"), cap=12, limit=18, threshold=8, backfill=4).select("source_name", "doc_id", "bucket", "list_rank", "score")


@query(rf"""WITH {LINKS}, b AS (SELECT *, lower(anchor || chr(10) || chr(10) || url) AS low, coalesce({s_day("url")} = DATE '{CFG.target_date}', false) AS on_day FROM links_u),
f AS (SELECT *, {s_target("low")} AS target, {s_any("low", FIXTURE.priority)} AS priority,
    coalesce({s_day("url")} <> DATE '{CFG.target_date}' AND (contains(lower({s_norm("url")}), '/archive/') OR contains({s_host("url")}, 'reuters.com') OR {s_day("url")} < DATE '{CFG.target_date}'), false) AS old FROM b)
SELECT listing_url, listing_url || '#' || lpad(CAST(ord AS VARCHAR), 6, '0') AS ord_text, NOT old AND NOT ({s_any("low", FIXTURE.company)} AND NOT priority AND NOT on_day) AND (target OR {s_any("low", FIXTURE.structure)} OR priority OR on_day) AS listed,
    {s_candidate("anchor", "url")} - CASE WHEN {s_section_page("url")} THEN 10 ELSE 0 END + CASE WHEN target THEN 7 ELSE -{CFG.shortlist_non_target_penalty} END + {s_sum("low", FIXTURE.priority, 3)} + CASE WHEN on_day THEN 10 ELSE 0 END
    - CASE WHEN contains(lower(url), '/archive/') THEN 8 ELSE 0 END - CASE WHEN contains({s_host("url")}, 'reuters.com') AND NOT on_day THEN 8 ELSE 0 END + CASE WHEN target AND priority THEN 7 ELSE 0 END + CASE WHEN suffix({s_path("url")}, '.pdf') THEN -{CFG.shortlist_pdf_penalty} ELSE {CFG.shortlist_html_bonus} + CASE WHEN {s_any(s_path("url"), U.REPORT_PATHS)} THEN 1 ELSE 0 END END AS score FROM f""")
def shortlist_scores(spark, sf_dir):
    listed, score = A.shortlist_score(CFG)
    return link_candidates(spark, sf_dir).select("listing_url", "ord_text", listed.alias("listed"), score.alias("score"))


@query(None)
def fast_prefilter(spark, sf_dir):
    sources = registry.fixture(spark).withColumn("host", F.explode("allowed_hosts"))
    rows = link_candidates(spark, sf_dir).withColumn("host", F.explode(U.host_suffixes("url"))).join(F.broadcast(sources), "host").withColumn("p", A.fast_prefilter(CFG))
    rows = X.bind(rows, p=F.col("p"))
    return rows.groupBy("source_name", "p.accepted", F.array_join("p.reasons", ",").alias("reasons")).agg(F.count("*").alias("n"), F.sum("p.score").alias("score"))


@query(rf"""WITH {DOCS}, s AS (SELECT doc_id, source, {s_relevance("title", "body")} AS score FROM docs_t),
r AS (SELECT *, score >= 10 AS ok, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS candidate_rank FROM s),
k AS (SELECT *, coalesce(sum(CAST(ok OR score >= 6 AS INT)) OVER (PARTITION BY source ORDER BY candidate_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r)
SELECT source AS source_name, doc_id, ok AS accepted FROM k WHERE ok OR (score >= 6 AND before < 6)""")
def prefilter_floor(spark, sf_dir):
    rows = docs(spark, sf_dir).select(F.col("source").alias("source_name"), "doc_id", L.relevance("title", "body", FIXTURE).alias("score"))
    return R.prefilter_floor(rows.withColumn("accepted", F.col("score") >= 10).withColumn("candidate_rank", F.col("doc_id"))).select("source_name", "doc_id", "accepted")


@query(rf"""WITH {DOCS}, s AS (SELECT doc_id, source, {s_relevance("title", "body")} AS score, doc_id % 5 = 0 AS is_pdf FROM docs_t), a AS (SELECT *, score >= 14 AS ok FROM s),
h AS (SELECT source, count(*) AS n FROM a WHERE ok AND NOT is_pdf GROUP BY source)
SELECT a.source AS source_name, doc_id, is_pdf FROM a LEFT JOIN h ON a.source = h.source WHERE NOT is_pdf OR coalesce(n, 0) < 2""")
def html_first_phase(spark, sf_dir):
    rows = docs(spark, sf_dir).select(F.col("source").alias("source_name"), "doc_id", (F.col("doc_id") % 5 == 0).alias("is_pdf"), (L.relevance("title", "body", FIXTURE) >= 14).alias("accepted"))
    return R.html_first(rows, 6).select("source_name", "doc_id", "is_pdf")


@query(rf"""WITH RECURSIVE {LINKS}, e AS (SELECT DISTINCT listing_url AS src, 'host ' || {s_host("url")} AS dst FROM links_u UNION SELECT DISTINCT 'host ' || {s_host("url")}, url FROM pages),
t AS (SELECT DISTINCT url, 0 AS depth FROM pages WHERE contains(url, '?page=') UNION SELECT e.dst, t.depth + 1 FROM t JOIN e ON t.url = e.src WHERE t.depth < 2)
SELECT url, min(depth) AS depth FROM t GROUP BY url""")
def traversal(spark, sf_dir):
    """What is reached in two steps from all paged listings: the hosts that they link to, and the pages of these hosts."""
    pages = table(spark, sf_dir, "pages")
    host = lambda c: F.concat(F.lit("host "), U.host_of(c))
    edges = D.links(pages).select(F.col("listing_url").alias("src"), host("url").alias("dst")).unionByName(pages.select(host("url").alias("src"), F.col("url").alias("dst"))).distinct()
    return D.reachable(edges, pages.where(F.contains("url", F.lit("?page="))).select("url"), 2)


@query("""WITH RECURSIVE b AS (SELECT DISTINCT 'customer ' || o_custkey AS c, 'part ' || l_partkey AS p FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
e AS (SELECT c AS src, p AS dst FROM b UNION ALL SELECT p, c FROM b),
t AS (SELECT 'customer ' || c_custkey AS url, 0 AS depth FROM customer WHERE c_mktsegment = 'BUILDING' UNION SELECT e.dst, t.depth + 1 FROM t JOIN e ON t.url = e.src WHERE t.depth < 2)
SELECT url, min(depth) AS depth FROM t GROUP BY url""")
def traversal_orders(spark, sf_dir):
    """Customers and parts reached in two steps over what was ordered, from all customers of a segment: edges and seeds grow with the tables."""
    orders, items, customers = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer"))
    name = lambda kind, c: F.concat(F.lit(f"{kind} "), F.col(c).cast("string"))
    bought = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).select(name("customer", "o_custkey").alias("src"), name("part", "l_partkey").alias("dst")).distinct()
    edges = bought.unionByName(bought.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return D.reachable(edges, customers.where("c_mktsegment = 'BUILDING'").select(name("customer", "c_custkey").alias("url")), 2)


@query(rf"""SELECT page_id, {s_host("url")} AS host, a.h AS allowed_host FROM pages, (VALUES ('example.com'), ('ththre.example.com'), ('example.net')) AS a(h)
WHERE {s_host("url")} = a.h OR suffix({s_host("url")}, '.' || a.h)""")
def host_suffix_join(spark, sf_dir):
    hosts = spark.createDataFrame([("example.com",), ("ththre.example.com",), ("example.net",)], "allowed_host string")
    return D.host_join(table(spark, sf_dir, "pages"), hosts).select("page_id", U.host_of("url").alias("host"), "allowed_host")


@query("""SELECT c_name AS name, v.k AS key FROM customer, (VALUES ('R#00000000'), ('00012'), ('77'), ('CUSTOMER#000000003 and more')) AS v(k) WHERE contains(lower(c_name), lower(v.k)) OR contains(lower(v.k), lower(c_name))""")
def alias_join(spark, sf_dir):
    terms = spark.createDataFrame([("R#00000000",), ("00012",), ("77",), ("CUSTOMER#000000003 and more",)], "key string")
    return D.alias_join(table(spark, sf_dir, "customer").select(F.col("c_name").alias("name")), terms)


@query(rf"""WITH h AS (SELECT DISTINCT {s_host("url")} AS host FROM pages), r AS (SELECT provider, host, term, base, 'site:' || host || ' ' || term || ' April 7, 2026' AS query
    FROM h, (VALUES ('google', 'https://www.google.com/search?q='), ('bing', 'https://www.bing.com/search?q=')) AS p(provider, base), (VALUES ('thor'), ('erin')) AS t(term))
SELECT provider, host, term, query, base || replace(url_encode(query), '%20', '+') AS request_url FROM r""")
def search_requests(spark, sf_dir):
    hosts = table(spark, sf_dir, "pages").select(U.host_of("url").alias("host")).distinct()
    return D.search_requests(hosts, ("google", "bing"), ("thor", "erin"), "2026-04-07").select("provider", "host", "term", "query", "request_url")


# --- Evidence and summaries ------------------------------------------------------------------------------------------

_E = S.FIXTURE_EVIDENCE
SENT = rf"""
sent_t AS (SELECT doc_id, i AS pos, s[i] AS sentence, {s_sum("lower(s[i])", _E[0], 3)} + {s_sum("lower(s[i])", _E[1], 2)} + {s_sum("lower(s[i])", _E[2])} + {s_sum("lower(s[i])", _E[3])} AS score
    FROM (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: {s_space("x")}), lambda x: x <> '') AS s FROM documents), unnest(generate_series(1, len(s))) AS u(i)),
best_t AS (SELECT doc_id, max(score) AS score, min(pos) AS pos, arg_min(sentence, pos) AS sentence FROM sent_t WHERE score > 0 GROUP BY doc_id, lower(sentence)),
rank_t AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rank FROM best_t)"""


@query(rf"""WITH {SENT} SELECT doc_id, rank, sentence, score FROM rank_t WHERE rank <= 8""")
def evidence_sentences(spark, sf_dir):
    return S.evidence_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", 8, _E)


@query(rf"""WITH {SENT} SELECT doc_id, string_agg(sentence, ' ' ORDER BY rank) AS synopsis, count(*) AS n FROM rank_t WHERE rank <= 5 GROUP BY doc_id""")
def evidence_synopsis(spark, sf_dir):
    """The array form of the same selection: no shuffle, the document's own row."""
    rows = table(spark, sf_dir, "documents").select("doc_id", S.evidence_sentences("text", 5, _E).alias("e"))
    return rows.where(F.size("e") > 0).select("doc_id", F.array_join("e", " ").alias("synopsis"), F.size("e").cast("long").alias("n"))


@query(rf"""SELECT doc_id, len(p) AS n_all, array_to_string(CASE WHEN len(p) <= 4 THEN p ELSE k END, chr(10)) AS kept FROM (
    SELECT doc_id, p, list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform(list_concat(p[1:2], p[-2:]), lambda x: [x])), lambda a, b: CASE WHEN list_contains(list_transform(a, lambda y: lower(y)), lower(b[1])) THEN a ELSE list_concat(a, b) END) AS k
    FROM (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {s_space("x")}), lambda x: x <> '') AS p FROM documents))""")
def key_paragraphs(spark, sf_dir):
    n_all = F.size(F.filter(F.transform(F.split(X.text("text"), "\n"), X.normalize_space), lambda p: p != ""))
    return table(spark, sf_dir, "documents").select("doc_id", n_all.alias("n_all"), F.array_join(R.first_paragraphs("text"), "\n").alias("kept"))


def s_cut(x: str, most: int) -> str:
    return rf"CASE WHEN length({x}) <= {most} THEN {x} ELSE regexp_replace(left({x}, {most}), '\s+$', '') || '...' END"


def s_flags(x: str, rules, none: str) -> str:
    found = ", ".join(f"CASE WHEN {s_any(x, t)} THEN {q(n)} END" for t, n in rules)
    return f"CASE WHEN len(list_filter([{found}], lambda v: v IS NOT NULL)) > 0 THEN list_filter([{found}], lambda v: v IS NOT NULL)[1:3] ELSE [{q(none)}] END"


SUMMARY = rf"""
split_t AS (SELECT *, list_filter(list_transform(string_split(regexp_replace(body, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: {s_space("x")}), lambda x: x <> '') AS s FROM docs_t),
each_t AS (SELECT doc_id, i AS pos, s[i] AS sentence, {s_sum("lower(s[i])", _E[0], 3)} + {s_sum("lower(s[i])", _E[1], 2)} + {s_sum("lower(s[i])", _E[2])} + {s_sum("lower(s[i])", _E[3])} AS score FROM split_t, unnest(generate_series(1, len(s))) AS u(i)),
first_t AS (SELECT doc_id, max(score) AS score, min(pos) AS pos, arg_min(sentence, pos) AS sentence FROM each_t WHERE score > 0 GROUP BY doc_id, lower(sentence)),
five_t AS (SELECT doc_id, list(sentence ORDER BY rank) AS best FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rank FROM first_t) WHERE rank <= 5 GROUP BY doc_id),
chosen_t AS (SELECT d.*, coalesce(f.best, d.s[1:4]) AS chosen FROM split_t d LEFT JOIN five_t f ON d.doc_id = f.doc_id),
sum_t AS (SELECT *, CASE {" ".join(f"WHEN {s_any('lower(title || chr(32) || body)', t)} THEN {q(n)}" for t, n in L.C.THEMES)} ELSE {q(L.C.THEME_DEFAULT)} END AS theme,
    CASE WHEN u > d THEN 'Bullish' WHEN d > u THEN 'Bearish' WHEN u > 0 THEN 'Mixed' ELSE 'Neutral' END AS stance,
    CASE WHEN trim(array_to_string(chosen, ' ')) <> '' THEN trim(array_to_string(chosen, ' ')) ELSE {s_cut("body", 400)} END AS synopsis,
    CASE WHEN len(chosen) > 0 THEN chosen[1:3] ELSE ['Relevant commentary detected but extraction was thin.'] END AS key_points,
    {s_flags("lower(body)", S.RISKS, S.NO_RISK)} AS risk_flags, {s_flags("lower(body)", S.WATCHES, S.NO_WATCH)} AS watch_items
    FROM (SELECT *, {s_sum("lower(title || chr(10) || body)", L.C.STANCE_BULL)} AS u, {s_sum("lower(title || chr(10) || body)", L.C.STANCE_BEAR)} AS d FROM chosen_t))"""


@query(rf"""WITH {DOCS}, {SUMMARY} SELECT doc_id, theme, stance, length(synopsis) AS n_synopsis, len(key_points) AS n_points, array_to_string(risk_flags, ';') AS risks, array_to_string(watch_items, ';') AS watch FROM sum_t""")
def rule_summary(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", S.rule_summary("title", "body", _E).alias("s"))
    return rows.select("doc_id", "s.theme", "s.stance", F.length("s.synopsis").alias("n_synopsis"), F.size("s.key_points").alias("n_points"), F.array_join("s.risk_flags", ";").alias("risks"), F.array_join("s.watch_items", ";").alias("watch"))


def articles(spark, sf_dir) -> DataFrame:
    """Documents in the place of articles."""
    return docs(spark, sf_dir).select(
        F.col("source").alias("source_name"), F.concat(F.lit("https://example.com/"), F.col("doc_id").cast("string")).alias("source_url"), "title", F.lit("").alias("author"), F.lit("2026-04-07T00:00:00+00:00").alias("published_at"), F.col("body").alias("body_text"), L.scope("title", "body", FIXTURE).alias("scope"),
        F.array(F.concat(F.lit("lang:"), F.col("lang"))).alias("warnings"), "doc_id", L.relevance("title", "body", FIXTURE).alias("score"),
    )


def brief_table(spark, sf_dir) -> DataFrame:
    rows = X.bind(articles(spark, sf_dir), summary=S.rule_summary("title", "body_text", _E)).withColumn("mode", F.lit("rule"))
    return S.brief_rows(rows, "run-1", "2026-04-07T06:00:00+00:00", CFG)


def s_bullets(points: str, most: int) -> str:
    return s_cut(f"array_to_string(list_transform(list_filter({points}, lambda p: p <> ''), lambda p: '- ' || p), chr(10))", most)


BRIEF = rf"""
brief_t AS (SELECT {s_cut("CASE WHEN title = '' THEN coalesce(source, '') || ' Analyst Brief' ELSE title END", 250)} AS Title, '2026-04-07' AS BriefDate, source AS SourceName, 'https://example.com/' || doc_id AS SourceUrl, '2026-04-07T00:00:00+00:00' AS PublishedAt,
    '' AS ArticleAuthor, {s_scope("lower(title || chr(10) || body)")} AS Metal, theme AS Theme, stance AS Stance, {s_cut(s_space("synopsis"), 6000)} AS Synopsis, {s_bullets("key_points", 6000)} AS KeyPoints, {s_bullets("risk_flags", 4000)} AS RiskFlags, {s_bullets("watch_items", 4000)} AS WatchItems,
    '2026-04-07T06:00:00+00:00' AS GeneratedAt, 'rule' AS GenerationMode, coalesce('lang:' || lang, '') AS Warnings, {s_cut("body", 12000)} AS RawExcerpt, 'run-1' AS RunId,
    left(sha256(lower(trim('https://example.com/' || doc_id)) || '||' || lower(trim(title)) || '||' || '2026-04-07t00:00:00+00:00'), 40) AS UniqueKey FROM sum_t)"""


@query(rf"""WITH {DOCS}, {SUMMARY}, {BRIEF} SELECT * FROM brief_t""")
def brief_rows(spark, sf_dir):
    return brief_table(spark, sf_dir)


KEYED = "keyed AS (SELECT doc_id, left(sha256(lower(trim(coalesce(source, ''))) || '||' || lower(trim(coalesce(lang, '')))), 40) AS k, lang FROM documents), held AS (SELECT DISTINCT k FROM keyed WHERE lang = 'en'), firsts AS (SELECT k, min(doc_id) AS doc_id FROM keyed GROUP BY k)"


def keyed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", X.stable_key("source", "lang").alias("UniqueKey"), F.col("doc_id").alias("ord"))
    return rows, rows.where("lang = 'en'").select("UniqueKey")


@query(f"""WITH {KEYED} SELECT k AS "UniqueKey", doc_id FROM firsts WHERE k NOT IN (SELECT k FROM held)""")
def sink_new_rows(spark, sf_dir):
    return sinks.new_rows(*keyed(spark, sf_dir)).select("UniqueKey", "doc_id")


@query(f"""WITH {KEYED} SELECT keyed.k AS "UniqueKey", keyed.doc_id FROM keyed WHERE NOT EXISTS (SELECT 1 FROM firsts f WHERE f.k = keyed.k AND f.doc_id = keyed.doc_id AND f.k NOT IN (SELECT k FROM held))""")
def sink_duplicates(spark, sf_dir):
    return sinks.duplicate_rows(*keyed(spark, sf_dir)).select("UniqueKey", "doc_id")


@query(f"""WITH {KEYED} SELECT n AS created, t - n AS skipped, t AS total FROM (SELECT count(*) AS n FROM firsts WHERE k NOT IN (SELECT k FROM held)), (SELECT count(*) AS t FROM keyed)""")
def sink_counters(spark, sf_dir):
    rows, existing = keyed(spark, sf_dir)
    return sinks.counters(sinks.new_rows(rows, existing), sinks.duplicate_rows(rows, existing))


def s_points(x: str) -> str:
    """Lines without bullets, the first of each; one line alone goes by semicolons only if it is empty, so these texts have none."""
    lines = rf"list_filter(list_transform(string_split({x}, chr(10)), lambda v: {s_space("regexp_replace(v, '^[-*•· ]+', '')")}), lambda v: v <> '')"
    return f"list_filter({lines}, lambda v, i: list_position({lines}, v) = i)"


def s_section(x: str) -> str:
    low = f"lower(Theme || ' ' || Stance || ' ' || {x})"
    return f"CASE WHEN {s_any(low, L.C.DIGEST_INVENTORY)} THEN 'inventory' WHEN {s_any(low, L.C.DIGEST_PRICE)} THEN 'price' WHEN {s_any(low, L.C.DIGEST_OUTLOOK)} THEN 'outlook' ELSE 'drivers' END"


@query(rf"""WITH {DOCS}, {SUMMARY}, {BRIEF},
label_t AS (SELECT *, CASE Metal WHEN 'Copper, Aluminum' THEN 'Copper & Aluminium' WHEN 'Aluminum' THEN 'Aluminium' ELSE Metal END AS label, {s_space("SourceName")} AS source, {s_space("Synopsis")} AS syn FROM brief_t),
list_t AS (SELECT label, source, SourceUrl AS url, UniqueKey AS row_ord, list_concat(list_concat([{{'t': syn, 's': {s_section("syn")}}}], list_transform({s_points("KeyPoints")}, lambda p: {{'t': p, 's': {s_section("p")}}})),
    list_transform(list_concat(list_concat({s_points("WatchItems")}, {s_points("RiskFlags")}), ['Analyst tone remains ' || lower(Stance) || ' around ' || lower(Theme) || '.']), lambda p: {{'t': p, 's': 'outlook'}})) AS ps FROM label_t),
point_t AS (SELECT label, ps[i].s AS section, ps[i].t AS text, source, url, row_ord, i - 1 AS point_ord FROM list_t, unnest(generate_series(1, len(ps))) AS u(i) WHERE length(ps[i].t) >= 18),
once_t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label, section, lower(text) ORDER BY row_ord, point_ord) AS n FROM point_t) WHERE n = 1),
own_t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label, section ORDER BY row_ord, point_ord) AS place FROM once_t) WHERE place <= 4),
pool_t AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY list_position(['drivers', 'price', 'inventory', 'outlook'], section), place) AS turn FROM own_t),
need_t AS (SELECT l.label, v.section FROM (SELECT DISTINCT label FROM own_t) l, (VALUES ('price'), ('drivers'), ('inventory'), ('outlook')) AS v(section) WHERE NOT EXISTS (SELECT 1 FROM own_t o WHERE o.label = l.label AND o.section = v.section))
SELECT label, section, place, text, source, url FROM own_t UNION ALL SELECT n.label, n.section, p.turn, p.text, p.source, p.url FROM need_t n JOIN pool_t p ON p.label = n.label AND p.turn <= 2""")
def digest_groups(spark, sf_dir):
    return S.digest_groups(brief_table(spark, sf_dir), "UniqueKey").select("label", "section", "place", "text", "source", "url")


@query(rf"""WITH {DOCS}, s AS (SELECT doc_id, {s_relevance("title", "body")} AS score, doc_id % 3 = 0 AS dated FROM docs_t)
SELECT CAST(doc_id AS VARCHAR) AS source_url, CASE WHEN dated THEN '' ELSE '2026-04-0' || (doc_id % 9 + 1) END AS published_at, score FROM s ORDER BY published_at DESC, score DESC, source_url LIMIT 40""")
def final_order(spark, sf_dir):
    rows = docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("source_url"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("2026-04-0"), (F.col("doc_id") % 9 + 1).cast("string"))).alias("published_at"), L.relevance("title", "body", FIXTURE).alias("score"))
    return R.final_order(rows, 40)


@query(rf"""WITH {PAGES}, v AS (SELECT norm_url, page_id, {s_relevance("title", "body")} AS r, length(body) AS n FROM pages_t)
SELECT norm_url, max(page_id) AS page_id FROM v JOIN (SELECT norm_url, max(r * 1000000 + n) AS m FROM v GROUP BY norm_url) USING (norm_url) WHERE r * 1000000 + n = m GROUP BY norm_url""")
def better_page(spark, sf_dir):
    rows = pages(spark, sf_dir).withColumn("r", L.relevance("title", "body", FIXTURE))
    return R.better_page(rows, "norm_url", F.struct(F.col("r").alias("a"), F.length("body").alias("b")), "page_id").select("norm_url", "page_id")


@query(r"""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS first_kind FROM events""")
def warnings_map(spark, sf_dir):
    """Key and value warnings read back by their first key."""
    k = F.get_json_object("props", "$.k")
    w = F.array(F.concat(F.lit("k:"), k), F.concat(F.lit("kind:"), F.col("event_type")), F.lit("kind:later"), F.lit("plain"))
    return table(spark, sf_dir, "events").select("event_id", sinks.warning_value(w, "k").cast("long").alias("k"), sinks.warning_value(w, "kind").alias("first_kind"))


@query(rf"""WITH f AS (SELECT {s_space("source")} AS source, min(doc_id) AS d FROM documents GROUP BY 1) SELECT source, row_number() OVER (ORDER BY d, source) AS place FROM f WHERE source <> '' QUALIFY place <= 8""")
def sources_used(spark, sf_dir):
    """The first eight sources in the order of the documents."""
    return S.sources_used(table(spark, sf_dir, "documents").select(F.col("source").alias("SourceName"), "doc_id"), "doc_id")


# --- Walks with budgets, gates, fetching ------------------------------------------------------------------------------

_WALK = """bought AS (SELECT DISTINCT c_mktsegment AS source_name, c_custkey AS c, l_partkey AS p FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey),
e AS (SELECT source_name, 'customer ' || c AS src, 'part ' || p AS dst, p AS rank FROM bought UNION ALL SELECT source_name, 'part ' || p, 'customer ' || c, c FROM bought),
links AS (SELECT source_name, src, dst, row_number() OVER (PARTITION BY source_name, src ORDER BY rank, dst) AS turn FROM e QUALIFY turn <= 20),
v0 AS (SELECT c_mktsegment AS source_name, 'customer ' || c_custkey AS url, 0 AS depth, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS place FROM customer QUALIFY place <= 3)"""


def s_walk(step: int) -> str:
    """The next level of the queue, by SQL."""
    old = f"v{step - 1}"
    return f"""n{step} AS (SELECT source_name, dst AS url, v.place AS from_place, turn FROM {old} v JOIN links USING (source_name) WHERE v.depth = {step - 1} AND links.src = v.url
    QUALIFY row_number() OVER (PARTITION BY source_name, dst ORDER BY v.place, turn) = 1),
m{step} AS (SELECT n.*, row_number() OVER (PARTITION BY source_name ORDER BY from_place, turn, url) + (SELECT max(place) FROM {old} o WHERE o.source_name = n.source_name) AS place
    FROM n{step} n WHERE NOT EXISTS (SELECT 1 FROM {old} o WHERE o.source_name = n.source_name AND o.url = n.url)),
v{step} AS (SELECT * FROM {old} UNION ALL SELECT source_name, url, {step}, place FROM m{step} WHERE place <= 30)"""


@query(f"WITH {_WALK}, {s_walk(1)}, {s_walk(2)} SELECT source_name, url, depth, place FROM v2")
def budgeted_traversal(spark, sf_dir):
    """Walks from three customers of each segment over all that was bought: twenty links a node, thirty nodes a segment, two steps."""
    from .persist import written

    orders, items, customers = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer"))
    name = lambda kind, c: F.concat(F.lit(f"{kind} "), F.col(c).cast("string"))
    own = customers.select(F.col("c_mktsegment").alias("source_name"), "c_custkey")
    bought = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).join(own, F.col("o_custkey") == F.col("c_custkey")).select("source_name", "c_custkey", "l_partkey").distinct()
    bought = written(bought, "bought")  # joined once for both ways and all rounds
    there = bought.select("source_name", name("customer", "c_custkey").alias("src"), name("part", "l_partkey").alias("dst"), F.col("l_partkey").alias("rank"))
    back = bought.select("source_name", name("part", "l_partkey").alias("src"), name("customer", "c_custkey").alias("dst"), F.col("c_custkey").alias("rank"))
    seeds = R.top_per(own.select("source_name", name("customer", "c_custkey").alias("url"), F.col("c_custkey").alias("ord")), ["source_name"], [F.col("ord")], 3)
    return D.budgeted_traversal(there.unionByName(back), seeds.drop("rank"), 2, 30, 20, written)


@query(rf"""WITH {DOCS}, s AS (SELECT source, CAST(doc_id AS VARCHAR) AS url, {s_relevance("title", "body")} AS score FROM docs_t),
k AS (SELECT source, length(source) % 2 = 0 AS news, count(*) FILTER (WHERE score >= 12) AS b, count(*) FILTER (WHERE score BETWEEN 8 AND 11) AS m, count(*) FILTER (WHERE score BETWEEN 5 AND 7) AS o FROM s GROUP BY source),
g AS (SELECT *, CASE WHEN news AND b < 14 THEN m ELSE 0 END AS more FROM k)
SELECT source AS source_name, stage, n FROM (SELECT source, 'rss' AS stage, b AS n FROM g UNION ALL SELECT source, 'search', more FROM g UNION ALL SELECT source, 'external', CASE WHEN b + more < 12 THEN o ELSE 0 END FROM g) WHERE n > 0""")
def stage_gates(spark, sf_dir):
    """Which stages each source's candidates come from: the search engines and outside providers serve only the sources left short."""
    rows = docs(spark, sf_dir).select(F.col("source").alias("source_name"), F.col("doc_id").cast("string").alias("url"), L.relevance("title", "body", FIXTURE).alias("score"))
    sources = rows.select("source_name").distinct().withColumn("source_role", F.when(F.length("source_name") % 2 == 0, "narrative_news").otherwise("market_research"))
    found = D.gated(D.union_stages({"rss": rows.where("score >= 12")}), sources, CFG, rows.where("score BETWEEN 8 AND 11"), rows.where("score BETWEEN 5 AND 7"))
    return found.groupBy("source_name", "stage").agg(F.count("*").alias("n"))


_ATTEMPTS = rf"""ways AS (SELECT page_id, page_id % 11 <> 5 AS robots_ok, page_id % 13 = 6 AS paused, w.way AS way,
        CASE w.way WHEN 'http' THEN CASE WHEN page_id % 5 = 0 THEN 403 WHEN page_id % 7 = 3 THEN NULL ELSE 200 END ELSE 200 END AS code,
        CASE w.way WHEN 'http' THEN CASE WHEN page_id % 3 = 0 THEN substr(html, 1, 900) ELSE html END WHEN 'dynamic' THEN html ELSE html || html END AS html
    FROM pages, (VALUES ('http'), ('dynamic'), ('stealthy')) AS w(way)),
got AS (SELECT page_id, way, robots_ok AND NOT paused AS asked, CASE WHEN NOT robots_ok THEN 'robots_blocked' WHEN paused THEN 'host_paused' WHEN code IS NULL THEN 'failed' ELSE way END AS answer,
        CASE WHEN NOT robots_ok THEN 999 WHEN paused THEN 429 ELSE coalesce(code, 599) END AS status, CASE WHEN robots_ok AND NOT paused THEN html ELSE '' END AS html FROM ways),
told AS (SELECT *, {s_space("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title, {s_space("regexp_replace(regexp_extract(html, '<article>((?s:.)*)</article>', 1), '<[^>]*>', ' ', 'g')")} AS body, {s_any(f"lower({s_space('html')})", L.C.BLOCK_PHRASES)} AS block FROM got),
points AS (SELECT *, CASE WHEN status BETWEEN 200 AND 399 THEN 4 WHEN status < 500 THEN 1 ELSE 0 END + CASE WHEN title <> '' THEN 3 ELSE 0 END + least(4, length(html) // 1200) + least(4, length(body) // 600) + CASE WHEN length(body) >= 120 THEN 2 ELSE 0 END - CASE WHEN block THEN 6 ELSE 0 END AS quality,
        status >= 400 OR html = '' OR block OR title = '' OR length(body) < 120 OR length(html) < 1500 AS weak FROM told),
two AS (SELECT h.page_id, h.weak AS rendered, CASE WHEN h.weak AND d.quality > h.quality THEN d ELSE h END AS b FROM points h JOIN points d ON d.page_id = h.page_id WHERE h.way = 'http' AND d.way = 'dynamic')"""


@query(rf"""WITH {_ATTEMPTS}, three AS (SELECT two.page_id, rendered, b.weak OR b.block OR b.status IN (401, 403, 429) AS stealth, b, s FROM two JOIN points s ON s.page_id = two.page_id AND s.way = 'stealthy'),
best AS (SELECT page_id, CASE WHEN stealth AND s.quality > b.quality THEN s ELSE b END AS x, 1 + CAST(rendered AS INT) + CAST(stealth AS INT) AS n_tried FROM three)
SELECT page_id, x.answer AS answer, x.status AS status, x.quality AS quality, n_tried FROM best""")
def fetch_escalation(spark, sf_dir):
    """The pages as three ways of fetching give them, some cut short, refused, paused or unanswered, and the page that is taken."""
    from ..sources import connectors

    p = table(spark, sf_dir, "pages").withColumn("robots_ok", F.col("page_id") % 11 != 5).withColumn("paused", F.col("page_id") % 13 == 6)
    code = F.when(F.col("page_id") % 5 == 0, 403).when(F.col("page_id") % 7 == 3, F.lit(None).cast("int")).otherwise(200)
    plain = F.when(F.col("page_id") % 3 == 0, F.substring("html", 1, 900)).otherwise(F.col("html"))
    ways = [("http", code, plain), ("dynamic", F.lit(200), F.col("html")), ("stealthy", F.lit(200), F.concat("html", "html"))]
    rows = p.select("page_id", "robots_ok", "paused", F.explode(F.array(*[F.struct(F.lit(w).alias("method"), c.alias("status_code"), h.alias("html")) for w, c, h in ways])).alias("w")).select("page_id", "robots_ok", "paused", "w.*")
    rows = connectors.answered(rows.withColumn("title", H.title_tag("html")).withColumn("body", H.article_text("html")).withColumnRenamed("page_id", "requested_url"))
    return connectors.escalated(rows, "article", 120, js_heavy=True).select(F.col("requested_url").alias("page_id"), "answer", "status", "quality", "n_tried")


# --- Pages: main text, profiles, dates -------------------------------------------------------------------------------


def s_escaped(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def nested_pages(spark, sf_dir) -> DataFrame:
    """The documents as pages: every line a paragraph in a box of its own, odd ones on the left, even ones on the right, all in one article box beside a menu."""
    lines = F.split(F.replace(F.replace(F.replace(X.text("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), "\n")
    boxes = F.transform(lines, lambda x, i: F.concat(F.when(i % 2 == 0, "<div class='box left'><div><p>").otherwise("<div class='box right'><div><p>"), x, F.lit("</div></div>")))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("<nav><p>A menu that is long enough to be taken for a paragraph</p></nav><div><div class='wide article-content'>"), F.array_join(boxes, ""), F.lit("</div></div><footer><ul><li>A footer that is long enough to be taken for an item</ul></footer>")).alias("html"))


def s_told(lines: str, least: int = 30) -> str:
    """Lines long enough and without boilerplate, the first of each, one a line."""
    clean = f"list_filter(list_transform({lines}, lambda v: {s_space('v')}), lambda v: length(v) >= {least} AND NOT ({s_any('lower(v)', X.BOILERPLATE)}))"
    lows = f"list_transform({clean}, lambda v: lower(v))"
    return f"array_to_string(list_filter({clean}, lambda v, i: list_position({lows}, lower(v)) = i), chr(10))"


@query(rf"""WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
t AS (SELECT doc_id, {s_told("ls")} AS own, {s_told("list_concat(['A menu that is long enough to be taken for a paragraph'], ls)", 40)} AS rest FROM l)
SELECT doc_id, CASE WHEN length(own) >= 200 THEN 'css:.article-content' ELSE 'paragraphs' END AS method, length(CASE WHEN length(own) >= 200 THEN own ELSE rest END) AS n_chars, md5(CASE WHEN length(own) >= 200 THEN own ELSE rest END) AS text_md5 FROM t""")
def main_text(spark, sf_dir):
    """Main text of nested pages by the first scope with enough."""
    rows = X.bind(nested_pages(spark, sf_dir).withColumn("dom", N.tree("html")), body=N.main_text(F.col("dom"), 200))
    return rows.select("doc_id", "body.method", F.length("body.text").alias("n_chars"), F.md5("body.text").alias("text_md5"))


@query(rf"""WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
t AS (SELECT doc_id, {s_told("list_filter(ls, lambda v, i: i % 2 = 1)")} AS one, {s_told("list_filter(ls, lambda v, i: i % 2 = 0)")} AS two, {s_told("ls")} AS every FROM l),
p AS (SELECT doc_id, 'left' AS source_name, CASE WHEN length(one) >= 100 THEN 'profile:div.left' WHEN length(every) >= 100 THEN 'profile:.article-content' ELSE '' END AS method, CASE WHEN length(one) >= 100 THEN one WHEN length(every) >= 100 THEN every ELSE '' END AS x FROM t
      UNION ALL SELECT doc_id, 'right', CASE WHEN length(two) >= 100 THEN 'profile:.wide > .right' ELSE '' END, CASE WHEN length(two) >= 100 THEN two ELSE '' END FROM t)
SELECT doc_id, source_name, method, length(x) AS n_chars, md5(x) AS text_md5 FROM p""")
def profile_bodies(spark, sf_dir):
    """Bodies of the same pages by the selectors of two sources."""
    profiles = registry.from_specs(spark, [{"source_name": "left", "article_body_selectors": ["div.left", "p[", ".article-content"]}, {"source_name": "right", "article_body_selectors": [".wide > .right"]}])
    # Every page, parsed once, stands once for each of the two sources; the sources go to the pages, as by source there would be two tasks.
    parsed = nested_pages(spark, sf_dir).select("doc_id", N.tree("html").alias("dom"))
    both = parsed.withColumn("source_name", F.explode(F.array(F.lit("left"), F.lit("right")))).join(F.broadcast(profiles.select("source_name", "article_body_selectors", "body_steps")), "source_name")
    rows = X.bind(both, body=N.profile_text(F.col("dom"), F.col("article_body_selectors"), F.col("body_steps"), F.lit(100)))
    return rows.select("doc_id", "source_name", "body.method", F.length("body.text").alias("n_chars"), F.md5("body.text").alias("text_md5"))


def shown_dates(spark, sf_dir) -> DataFrame:
    """The pages with dates in the head, in a header, in a byline (of every second) and in a hint (of two thirds)."""
    day = lambda n: (F.col("page_id") % n + 1).cast("string")
    head = F.concat(F.lit("<meta property='article:published_time' content='2026-04-0"), day(9), F.lit("'><header><time datetime='2026-03-0"), day(7), F.lit("'>then</time></header>"))
    byline = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<p class='post-date'>April <b>"), day(9), F.lit("</b>, 2026</p>"))).otherwise("")
    return dated_pages(spark, sf_dir).withColumn("html", F.concat(head, byline, X.text("html")))


_EVIDENCE = r"""shown AS (SELECT page_id, '2026-04-0' || (page_id % 9 + 1) AS meta, '2026-03-0' || (page_id % 7 + 1) AS t, CASE WHEN page_id % 2 = 0 THEN 'April ' || (page_id % 9 + 1) || ' , 2026' ELSE '' END AS byline, CASE WHEN page_id % 3 > 0 THEN '2 hours ago' ELSE '' END AS hint, html NOT LIKE '%<article%' AND html NOT LIKE '%<main%' AS bare FROM pages),
ranked AS (SELECT page_id, list_filter([{'l': 'meta:article:published_time', 'v': meta}, {'l': 'visible_date_selector', 'v': t}, {'l': 'visible_date_selector', 'v': t}, {'l': 'visible_date_selector', 'v': byline}, {'l': 'node_time_tags', 'v': CASE WHEN bare THEN t ELSE '' END}, {'l': 'candidate_published_hint', 'v': hint}], lambda x: x.v <> '') AS e FROM shown)"""


@query(rf"""WITH {_EVIDENCE} SELECT page_id, i AS place, e[i].l AS label, e[i].v AS value FROM ranked, unnest(generate_series(1, len(e))) AS s(i)""")
def date_evidence(spark, sf_dir):
    """All that pages say of their dates, in order of trust."""
    rows = X.bind(shown_dates(spark, sf_dir).withColumn("dom", N.tree("html")), found=N.page_evidence(F.col("dom"), H.jsonld_dates(H.jsonld_blocks("html")), F.col("published_hint"), F.coalesce(F.date_format(U.url_date("url"), "yyyy-MM-dd"), F.lit(""))))
    return rows.select("page_id", F.posexplode("found").alias("at", "e")).select("page_id", (F.col("at") + 1).alias("place"), "e.label", "e.value")


@query(rf"""WITH {_EVIDENCE}, hit AS (SELECT page_id, e, coalesce(list_position(list_transform(e, lambda x: x.v IN ('2026-04-07', '2 hours ago')), true), 0) AS place FROM ranked)
SELECT page_id, place > 0 AS same_day, array_to_string(list_transform(CASE WHEN place > 0 THEN e[1:place] ELSE e END, lambda x: x.l), ',') AS checked FROM hit""")
def date_match(spark, sf_dir):
    """Whether a page is of the day, and what was looked at up to the first date that says so."""
    cfg = page_config()
    rows = X.bind(shown_dates(spark, sf_dir).withColumn("dom", N.tree("html")), found=N.page_evidence(F.col("dom"), H.jsonld_dates(H.jsonld_blocks("html")), F.col("published_hint"), F.coalesce(F.date_format(U.url_date("url"), "yyyy-MM-dd"), F.lit(""))))
    rows = X.bind(rows, e=T.ranked_evidence(F.col("found"), cfg.target_date, cfg.run_date))
    return rows.select("page_id", "e.same_day", F.array_join("e.checked", ",").alias("checked"))


# --- Pages: quality, type, verification, acceptance ------------------------------------------------------------------


@query(rf"""WITH {PAGES} SELECT p.page_id, CAST(4 + CASE WHEN title <> '' THEN 3 ELSE 0 END + least(4, length(html) // 1200) + least(4, length(body) // 600) + CASE WHEN length(body) >= 120 THEN 2 ELSE 0 END
    - CASE WHEN {s_any(f"lower({s_space('html')})", L.C.BLOCK_PHRASES)} THEN 6 ELSE 0 END AS INTEGER) AS quality FROM pages_t p JOIN pages USING (page_id)""")
def page_quality(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").withColumn("title", H.title_tag("html")).withColumn("body", H.article_text("html")).withColumn("status", F.lit(200))
    return rows.select("page_id", A.page_quality("status", "html", "body", "title", "article", 120).alias("quality"))


@query(None)
def page_metrics(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", H.narrative_metrics("html").alias("m")).select("page_id", "m.*")


@query(None)
def page_type(spark, sf_dir):
    from . import engine

    rows = engine.extract(table(spark, sf_dir, "pages"), CFG)
    rows = rows.select("source_url", A.page_type("title", "body_text", F.col("source_url"), CFG, F.col("metrics"), H.quote_signal("title", "body_text", "source_url")).alias("page_type"))
    return rows.groupBy("page_type").agg(F.count("*").alias("n"))


def page_config() -> Config:
    return replace(CFG, target_date="2026-04-07", run_date="2026-04-07")


def dated_pages(spark, sf_dir) -> DataFrame:
    """Pages of which two thirds were listed as of today."""
    return table(spark, sf_dir, "pages").withColumn("published_hint", F.when(F.col("page_id") % 3 > 0, "2 hours ago").otherwise(""))


@query(None)
def page_verification(spark, sf_dir):
    from . import engine

    sources = registry.fixture(spark)
    own = engine.with_source(engine.one_of_each(dated_pages(spark, sf_dir)), sources, "url")
    rows = engine.verified(engine.extract(own, page_config(), tuple(sources.columns)), page_config())
    v = "verification"
    return rows.select("source_url", "source_name", f"{v}.has_target_metal", f"{v}.has_market_context", f"{v}.has_valid_same_day_date", f"{v}.page_type", f"{v}.score", f"{v}.confidence", F.array_join(f"{v}.reject_reasons", ",").alias("rejects"))


@query(None)
def article_acceptance(spark, sf_dir):
    from . import engine

    rows = engine.judge(dated_pages(spark, sf_dir), registry.fixture(spark), page_config())
    return rows.select("source_url", "source_name", "acceptance.accepted", "acceptance.score", F.array_join("acceptance.reasons", ",").alias("reasons"), "relevance.should_summarize", F.col("relevance.scope").alias("relevant_scope"))


@query(None)
def daily_run(spark, sf_dir):
    """The run from fetched pages on: brief rows of accepted articles. Discovery and shortlisting aren't part of it."""
    from . import engine

    found = engine.articles(dated_pages(spark, sf_dir), registry.fixture(spark), replace(page_config(), max_articles_total=1000, per_source_limit=200))
    return engine.briefs(found, page_config(), "run-1", "2026-04-07T06:00:00+00:00", _E).select("UniqueKey", "Title", "SourceName", "SourceUrl", "Metal", "Theme", "Stance")


def found_stages(spark, sf_dir) -> dict[str, DataFrame]:
    """Candidates of two stages: the pages as a feed tells of them, two thirds as of the day, and the links between pages."""
    told = pages(spark, sf_dir).select("url", U.host_of("url").alias("listing_url"), F.col("title").alias("title_hint"), X.truncate_text("body", 200).alias("snippet_hint"), F.when(F.col("page_id") % 3 > 0, "2 hours ago").otherwise("").alias("published_hint"), F.lit("rss").alias("method"), F.col("page_id").alias("ord"))
    feed = told.withColumn("score", L.candidate_score("title_hint", "url", "snippet_hint", page_config()) + 4)
    return {"rss": feed, "traversal": link_candidates(spark, sf_dir).withColumn("ord", F.shiftright(F.xxhash64("ord_text"), 20)).drop("ord_text")}


@query(None)
def full_run(spark, sf_dir):
    """The run from discovery on: candidates of all pages and links, short list, fast filter, pages, acceptance, budgets, brief rows."""
    from . import engine

    cfg = replace(page_config(), max_articles_total=1000, per_source_limit=200, max_candidates=1200)
    found = engine.collect(found_stages(spark, sf_dir), table(spark, sf_dir, "pages"), registry.fixture(spark), cfg)
    return engine.briefs(found, cfg, "run-1", "2026-04-07T06:00:00+00:00", _E).select("UniqueKey", "Title", "SourceName", "SourceUrl", "Metal", "Theme", "Stance")


@query(None)
def run_counters(spark, sf_dir):
    """Candidates by stage and method, and of the short list how many name a target or a day."""
    from . import engine

    stages = found_stages(spark, sf_dir)
    wanted = engine.short_listed(stages, registry.fixture(spark), page_config())
    by_method = D.union_stages(stages).groupBy("stage", "method").agg(F.count("*").alias("n_found"))
    kept = R.shortlist_counters(wanted, page_config())
    return by_method.join(kept, "method", "left").fillna(0)


# --- Events: the batch form of the streams ----------------------------------------------------------------------------


@query("""SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def events_daily(spark, sf_dir):
    return audit.daily(table(spark, sf_dir, "events"), "ts", "event_type")


@query("""SELECT user_id, event_type, min(event_id) AS event_id, count(*) AS n FROM events GROUP BY 1, 2""")
def events_dedup(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    first = R.best_by(events.select("user_id", "event_type", "event_id"), ["user_id", "event_type"], [-F.col("event_id")])
    return first.join(events.groupBy("user_id", "event_type").agg(F.count("*").alias("n")), ["user_id", "event_type"])


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 30 MINUTE AS ended, count(*) AS n FROM s GROUP BY user_id, k""")
def events_sessions(spark, sf_dir):
    return audit.sessions(table(spark, sf_dir, "events"), "user_id", "ts").select("user_id", "started", "ended", "n")


@query("""SELECT CASE WHEN grouping(event_type) = 1 THEN 'all' ELSE event_type END AS stage, CASE WHEN grouping(d) = 1 THEN NULL ELSE d END AS day, count(*) AS n, count_if(value > 50) AS n_high
FROM (SELECT event_type, CAST(ts AS DATE) AS d, value FROM events) GROUP BY ROLLUP (event_type, d)""")
def audit_rollup(spark, sf_dir):
    """An extension: counts by stage and day, with totals."""
    rows = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    out = rows.rollup("event_type", "day").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("n_high"), F.grouping("event_type").alias("g"))
    return out.select(F.when(F.col("g") == 1, "all").otherwise(F.col("event_type")).alias("stage"), "day", "n", "n_high")


@query("""SELECT u.event_type AS stage, count(DISTINCT user_id) AS users, count(*) AS n FROM events u GROUP BY 1""")
def audit_funnel(spark, sf_dir):
    """An extension: how many come to each stage."""
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("stage")).agg(F.countDistinct("user_id").alias("users"), F.count("*").alias("n"))
