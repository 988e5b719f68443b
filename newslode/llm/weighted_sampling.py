"""Document fingerprints by consistent weighted sampling, in DataFrame operations alone.

A text is its words, weighted by how often they occur. For each of the samples
k a word draws r and c (gamma, shape 2) and b (uniform) from a hash of the word and k;
with t = floor(ln w / r + b) its key is ln c - r * (t - b + 1), and the text's
k-th element is the word and t of least key. Two texts agree in an element with a probability
equal to the generalised Jaccard similarity of their weights. Gamma numbers are read from a table of
quantiles, since Spark's logarithms cost more than all the rest; equal weights are still sampled evenly, and unequal ones in proportion to within the table's steps.

All of it runs behind one shuffle: texts are dealt into ranges of ids, each a partition, in which a window finds
each document's successor; the first document of a range is copied into the range before as its
end. Words are counted inside the row, and the smallest keys of a row are
found by a hash aggregate in the same task, since the ranges already lie together.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions_for, text_rows

SAMPLES = 64
#: Cuts between ranges of ids that are looked for; more ranges divide these evenly.
CUTS = 1_000
LOW31 = (1 << 31) - 1
#: Bits of a hash that choose r, c, and c again where it falls into the first of its places.
R_BITS, C_BITS, FIRST_BITS = 10, 12, 10


def gamma_quantile(chance: np.ndarray) -> np.ndarray:
    """Of the gamma distribution of shape 2, by bisection."""
    low, high = np.zeros(len(chance)), np.full(len(chance), 64.0)
    for _ in range(80):
        mid = (low + high) / 2
        under = -np.expm1(-mid) - mid * np.exp(-mid) < chance
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return low


def draws() -> np.ndarray:
    """r by R_BITS, then ln c by C_BITS, then ln c within the first of these places by FIRST_BITS."""
    middle = lambda bits: (np.arange(1 << bits) + 0.5) / (1 << bits)
    return np.concatenate([gamma_quantile(middle(R_BITS)), np.log(gamma_quantile(middle(C_BITS))), np.log(gamma_quantile(middle(FIRST_BITS) / (1 << C_BITS)))])


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def weighted_terms(text: Column) -> Column:
    """array<struct<term: long, weight: int>>: each distinct word's hash and count. Words are lower-cased runs without ASCII white space."""
    words = F.filter(F.split(F.lower(text), "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    hashes = F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))

    def counted(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        ended = lambda st: F.transform(st, lambda x, j: F.struct(F.get(s, x).alias("term"), (F.coalesce(F.get(st, j + 1), F.size(s)) - x).alias("weight")))
        return F.when(F.size(s) > 0, let(starts, ended)).otherwise(F.array().cast("array<struct<term:bigint,weight:int>>"))

    return let(hashes, counted)


def sample_key(term: Column, log_weight: Column, k: int, table: Column) -> Column:
    """Key and element of a word's k-th sample in one long: 32 bits of the key above 31 bits that name word and t."""
    h = F.xxhash64(term, F.lit(k))
    part = lambda shift, bits: F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    place = part(R_BITS, C_BITS)
    r = F.get(table, part(0, R_BITS))
    log_c = F.get(table, F.when(place > 0, place + F.lit(1 << R_BITS)).otherwise(part(R_BITS + C_BITS, FIRST_BITS) + F.lit((1 << R_BITS) + (1 << C_BITS))))
    rest = R_BITS + C_BITS + FIRST_BITS
    beta = (F.shiftrightunsigned(h, rest) + F.lit(0.5)) * F.lit(2.0 ** (rest - 64))
    t = F.floor(log_weight / r + beta)
    # Keys lie between -100 and 10.
    level = ((log_c - r * (t - beta + 1) + F.lit(112.0)) * F.lit(float(1 << 24))).cast("long")
    name = F.shiftrightunsigned(h, 20).bitwiseXOR(t * F.lit(0x9E3779B1)).bitwiseAND(F.lit(LOW31))
    return F.shiftleft(level, 31).bitwiseOR(name)


def sha_words(text: Column) -> list[Column]:
    """SHA-256 of a text as four longs: a hash aggregate carries numbers, not strings."""
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("long") for i in range(4)]


def ranges(rows: DataFrame, n: int) -> tuple[Column, int]:
    """The range of a row by key and then mix (a number from 0 to 1), and how many ranges there are: about n, of like size.

    A key that fills several ranges is split by mix; between two cuts ids are taken to be spread evenly.
    """
    few = min(n, CUTS)
    found = rows.agg(F.percentile_approx("key", [i / few for i in range(1, few)] or [0.5], 10_000), F.min("key"), F.max("key")).first()
    cuts, low, high = list(found[0] or []), found[1] or 0, found[2] or 0
    each = -(-n // few)
    known = F.lit(np.array(cuts or [0], np.int64))
    below = F.size(F.filter(known, lambda x: x < F.col("key")))
    equal = F.size(F.filter(known, lambda x: x == F.col("key")))
    ends = F.lit(np.array([float(low) - 1, *map(float, cuts), float(high)]))
    before, after = F.get(ends, below), F.get(ends, below + 1)
    inside = F.when(after > before, (F.col("key").cast("double") - before - 1) / (after - before)).otherwise(0.0)
    place = below + F.when(equal > 1, F.col("mix") * equal).otherwise(F.least(F.greatest(inside, F.lit(0.0)), F.lit(1 - 1e-9)))
    return F.floor(place * each).cast("int"), (len(cuts) + 1) * each


def with_next(docs: DataFrame) -> DataFrame:
    """range, place, doc_id, text, next_text, ghost: each row and the text of the next by ascending doc_id (null first; ties by a
    hash of the text, then the text; after the last comes the first). Rows with ghost are a range's end, copied from another."""
    order = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    rows = text_rows(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", order).withColumn("hash", F.xxhash64("text"))
    rows = rows.withColumn("mix", F.col("hash") * F.lit(2.0**-64 * (1 - 1e-9)) + 0.5)
    own, n = ranges(rows, 4 * partitions_for(docs))
    rows = rows.withColumn("range", own)
    # A row for each range.
    heads = sorted((r[0], *r[1]) for r in rows.groupBy("range").agg(F.min(F.struct("key", "hash"))).collect())
    ends = [(key, mix, heads[i - 1][0]) for i, (_, key, mix) in enumerate(heads)]
    copies = F.broadcast(docs.sparkSession.createDataFrame(ends, "head long, head_hash long, into int"))
    both = rows.join(copies, (F.col("key") == F.col("head")) & (F.col("hash") == F.col("head_hash")), "left")
    here = F.struct(F.col("range").alias("range"), F.lit(False).alias("ghost"))
    there = F.struct(F.col("into").alias("range"), F.lit(True).alias("ghost"))
    dealt = both.select("doc_id", "key", "hash", "text", F.explode(F.when(F.col("into").isNull(), F.array(here)).otherwise(F.array(here, there))).alias("at")).select("doc_id", "key", "hash", "text", "at.range", "at.ghost")
    w = Window.partitionBy("range").orderBy("ghost", "key", "hash", "text")
    dealt = dealt.repartitionById(n, F.col("range"))
    placed = dealt.select("range", "doc_id", "text", "ghost", F.row_number().over(w).alias("place"), F.lead("text").over(w).alias("next_text"), F.lag("ghost").over(w).alias("ghost_before"))
    return placed.where(~F.col("ghost") | F.coalesce(~F.col("ghost_before"), F.lit(True))).drop("ghost_before")


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, a row for each row of docs.

    A null text is empty; texts without words have the empty fingerprint's elements
    (all ones) and are alike to each other. Repeated rows follow each other in the order of ids.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = with_next(docs).withColumn("edited", F.when(F.col("ghost"), F.lit("")).otherwise(edited))
    kinds = F.posexplode(F.when(F.col("ghost"), F.array("text")).otherwise(F.array("text", "edited"))).alias("kind", "body")
    texts = rows.select("range", "place", "doc_id", "ghost", kinds)
    # As a literal the table would stand in every sample's expression; what depends on a row stays a column.
    table = F.when(F.col("place") > 0, F.lit(draws())).alias("table")
    own = ["range", "place", "kind", "doc_id", "ghost", "n_chars"]
    shas = [F.col("sha")[i].alias(f"sha{i}") for i in range(4)]
    meta = texts.select("range", "place", "kind", "doc_id", "ghost", F.length("body").alias("n_chars"), F.when(F.col("kind") == 1, F.array(*sha_words(F.col("body")))).alias("sha"), weighted_terms(F.col("body")).alias("terms"), table)
    # A text without words keeps its row through the null that explode_outer gives it.
    terms = meta.select(*own, *shas, "table", F.explode_outer("terms").alias("x")).select(*own, *[f"sha{i}" for i in range(4)], "table", F.col("x.term").alias("term"), F.log(F.col("x.weight").cast("double")).alias("log_weight"))
    least = [F.min(sample_key(F.col("term"), F.col("log_weight"), k, F.col("table"))).alias(f"m{k}") for k in range(samples)]
    first = [F.first(c).alias(c) for c in ("doc_id", "ghost", "n_chars", "sha0", "sha1", "sha2", "sha3")]
    signed = terms.groupBy("range", "place", "kind").agg(*first, *least)
    # What is compared is what is shown: the name of a sample's word and t, and a bit of its key.
    sig = F.array(*[F.coalesce(F.col(f"m{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(0xFFFFFFFF)) for k in range(samples)])
    sha = F.concat(*[F.lpad(F.lower(F.hex(f"sha{i}")), 16, "0") for i in range(4)])
    signed = signed.select("range", "place", "kind", "doc_id", "ghost", "n_chars", sha.alias("sha"), sig.alias("sig"))
    w = Window.partitionBy("range").orderBy("place", "kind")
    beside = signed.select("*", F.lead("sig", 1).over(w).alias("edited_sig"), F.lead("sha", 1).over(w).alias("edited_sha256"), F.lead("sig", 2).over(w).alias("next_sig"))
    alike = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x) / F.lit(float(samples))
    shown = lambda s: F.array_join(F.transform(s, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")
    return beside.where((F.col("kind") == 0) & ~F.col("ghost")).select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", shown(F.col("sig")).alias("fingerprint"), shown(F.col("edited_sig")).alias("edited_fingerprint"), alike(F.col("sig"), F.col("edited_sig")).alias("near_edited"), alike(F.col("sig"), F.col("next_sig")).alias("near_next")
    )
