"""Language identification by rank order.

A profile is a list of n-grams, most frequent first. A document's distance to
a language is the sum, over the document's most frequent n-grams, of how far
each is out of place in the language's profile; the nearest language wins.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import held_out, texts_of

#: N-grams in a profile, of a language and of a document.
PROFILE = 300
#: Documents of each language (about) from which its profile is counted.
TRAIN_DOCS = 2_000
UNKNOWN = "und"
BITS = 21  # of a code point

_folded: np.ndarray | None = None


def folded() -> np.ndarray:
    """Code point to its lower-case letter; a space for all that isn't a letter."""
    global _folded
    if _folded is None:
        to = np.full(sys.maxunicode + 1, 32, np.int64)
        for i in range(sys.maxunicode + 1):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                to[i] = ord(low) if len(low) == 1 else i
        _folded = to
    return _folded


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of one to three letters, a space marking a word's edge, as numbers in ascending order, and how often each occurs."""
    a = folded()[np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), "<u4")]
    blank = a == 32
    keep = np.ones(len(a), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    a, blank = a[keep], blank[keep]
    if len(a) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    two = a[:-1] << BITS | a[1:]
    three = (two[:-1] << BITS | a[2:])[~blank[1:-1]]
    return np.unique(np.concatenate([a[~blank], two, three]), return_counts=True)


def most_frequent(codes: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Ties go to the smaller n-gram."""
    return codes[np.argsort(-counts, kind="stable")[:most]]


def profiles(docs: DataFrame, held: tuple[int, int], most: int = PROFILE, train_docs: int = TRAIN_DOCS) -> dict[str, np.ndarray]:
    """Language to its most frequent n-grams, counted over a sample of about train_docs documents of each language."""
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), *held))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.join(F.broadcast(sizes), "lang").where(draw * F.col("n") < train_docs)  # a row per language
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            langs = b.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                got = [grams(t) for t, x in zip(texts_of(b.column("text")), langs, strict=True) if x == lang]
                codes, place = np.unique(np.concatenate([c for c, _ in got]), return_inverse=True)
                n = np.bincount(place, weights=np.concatenate([n for _, n in got]), minlength=len(codes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(n)], schema=schema)

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    rows = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("lang", "gram", "rank").collect()  # most rows for each language
    out: dict[str, list] = {}
    for lang, gram, rank in sorted(rows, key=lambda r: (r[0], r[2])):
        out.setdefault(lang, []).append(gram)
    return {k: np.array(v, np.int64) for k, v in out.items()}


class Places:
    """Of every n-gram in any profile its place in each."""

    def __init__(self, known: dict[str, np.ndarray], most: int):
        self.langs = sorted(known)
        self.most = most
        self.codes = np.unique(np.concatenate([np.zeros(1, np.int64), *known.values()]))
        self.place = np.full((len(self.codes), len(self.langs)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.place[np.searchsorted(self.codes, known[lang]), k] = np.arange(len(known[lang]))

    def nearest(self, text: str | None) -> tuple[str, float]:
        codes, counts = grams(text or "")
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        top = most_frequent(codes, counts, self.most)
        at = np.minimum(np.searchsorted(self.codes, top), len(self.codes) - 1)
        place = np.where((self.codes[at] == top)[:, None], self.place[at], -1)
        out = np.where(place < 0, self.most, np.abs(place - np.arange(len(top))[:, None]))
        total = out.sum(0)
        best = int(np.argmin(total))
        return self.langs[best], float(1 - total[best] / (len(top) * self.most))


def identify(docs: DataFrame, held: tuple[int, int] = (4, 2), most: int = PROFILE, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score (1: all n-grams in place, 0: none known), a row for each row of docs.

    Null texts and texts without a letter are `und` with score 0, as are all if no
    language is known; ties between languages go to the first by name; rows
    without lang or doc_id teach nothing.
    """
    spark = docs.sparkSession
    places = spark.sparkContext.broadcast(Places(profiles(docs, held, most, train_docs), most))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = places.value
        for b in it:
            found = [near.nearest(t) for t in texts_of(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), *held).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
