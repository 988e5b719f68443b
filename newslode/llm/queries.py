"""The numbered queries: each applies its operator to its whole table and derives the contract's columns."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversation_trie, decontaminate, jaccard_join, language, license_scan, line_dedup, phrases, quality_crf, simhash, token_count, toxicity, weighted_sampling
from .common import stash, table


def tokenizer_path(name: str) -> str:
    """A public vocabulary file; NEWSLODE_TOKENIZERS names another folder."""
    folder = os.environ.get("NEWSLODE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(spark, table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), tokenizer_pattern())


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held=(5, 0), threshold=0.5)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5).drop("drops")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprints(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held=(4, 2), threshold=0.7)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), held=(4, 2))


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(spark, table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_pattern(), limit=512)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=13)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), threshold=100, most=2000)


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_sets(table(spark, sf_dir, "documents"), size=5, percent=80)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stash(conversation_trie.numbered(table(spark, sf_dir, "conversations")), "turns")
    return conversation_trie.prefix_trie(conversation_trie.rebuilt(turns))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_line_dedup": op3_line_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_fingerprints": op5_fingerprints,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_token_count": op8_token_count,
    "op9_simhash": op9_simhash,
    "op10_decontamination": op10_decontamination,
    "op11_phrases": op11_phrases,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_conversation_trie": op13_conversation_trie,
}

_BLANK = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE_SQL = {
    "op3_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), keyed AS (SELECT *, translate(trim(line, {_BLANK}), {_LOWER}) AS key FROM lines),
        lost AS (
            SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
        ), judged AS (
            SELECT k.*, l.key IS NOT NULL AND k.doc_id <> l.keeper AS drop_it FROM keyed k LEFT JOIN lost l ON k.key = l.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drop_it) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT drop_it), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op10_decontamination": rf"""
        WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{_WORD}') AS w FROM documents),
        bw AS (SELECT item_id, regexp_extract_all(translate(text, {_LOWER}), '{_WORD}') AS w FROM benchmark WHERE text IS NOT NULL),
        bwin AS (
            SELECT DISTINCT item_id, least(13, len(w)) AS l, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
            FROM bw, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS s(i) WHERE len(w) > 0
        ), ls AS (SELECT DISTINCT l FROM bwin),
        dwin AS (SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS g FROM dw, ls, unnest(generate_series(1, len(w) - l + 1)) AS s(i)),
        occ AS (SELECT DISTINCT doc_id, l, i, item_id FROM dwin JOIN bwin USING (l, g)),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + l - 1)) AS p FROM occ) GROUP BY doc_id),
        its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
        SELECT dw.doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
        FROM dw LEFT JOIN hit ON dw.doc_id = hit.doc_id LEFT JOIN its ON dw.doc_id = its.doc_id""",
    "op11_phrases": rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, doc_id, p, regexp_extract_all(piece, '[^\x20\x09]+') AS w
            FROM (SELECT lang, doc_id, unnest(s) AS piece, generate_subscripts(s, 1) AS p FROM (SELECT lang, doc_id, regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]') AS s FROM documents))
        ), g AS (
            SELECT lang, k, w[i:i + k - 1] AS g FROM pieces, unnest([1, 2, 3, 4, 5]) AS s(k), unnest(generate_series(1, len(w) - k + 1)) AS t(i)
        ), n AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM pieces GROUP BY lang),
        f AS (SELECT lang, k, g, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY lang, k, g HAVING count(*) >= 100),
        inside AS (SELECT DISTINCT lang, k - 1 AS k, f, unnest([g[1:k - 1], g[2:k]]) AS g FROM f WHERE k > 2),
        c AS (SELECT f.* FROM f WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM inside x WHERE x.lang = f.lang AND x.k = f.k AND x.g = f.g AND 100 * x.f >= 100 * f.f)),
        cuts AS (
            SELECT c.lang, c.g, c.f AS a, l.f AS l, r.f AS r, n.n, cut, 1000 * c.f * n.n // (l.f * r.f) AS score
            FROM c, unnest(range(1, c.k)) AS s(cut), f l, f r, n
            WHERE l.lang = c.lang AND l.g = c.g[1:cut] AND r.lang = c.lang AND r.g = c.g[cut + 1:] AND n.lang = c.lang
        ), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase,
               CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM best QUALIFY rank <= 2000""",
    "op13_conversation_trie": """
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), c AS (
            SELECT conv_id, conv_id - conv_id % 100 AS first_id,
                   xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                       lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM t)
        ), r AS (
            SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.first_id AND pos <= h
            UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h
        ), p AS (
            SELECT c.conv_id, coalesce(list({'r': role, 'x': text} ORDER BY part, pos) FILTER (WHERE role IS NOT NULL), []) AS path FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id
        ), m AS (SELECT conv_id, d, path[1:d] AS k, len(path) AS n FROM p, unnest(range(len(path) + 1)) AS s(d)),
        n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends FROM m GROUP BY k, d),
        kids AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
        f AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(k[d].x) END AS own FROM n LEFT JOIN kids USING (k)),
        sums AS (SELECT v.conv_id, v.d, sum(u.own) AS saved_tokens, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves FROM f v JOIN f u ON u.d >= v.d AND u.k[1:v.d] = v.k GROUP BY v.conv_id, v.d)
        SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
        FROM f JOIN sums ON sums.conv_id = f.conv_id AND sums.d = f.d LEFT JOIN f up ON f.d > 0 AND up.d = f.d - 1 AND up.k = f.k[1:f.d - 1]""",
}
