"""SimHash near-dedup by anchor points.

The 64 bits of a fingerprint are cut into blocks of 23, 23 and 15 bits, each
with a perfect code (Golay, radius 3; Golay; Hamming, radius 1), and 3 bits
left free; the anchors are the products of their code words (2^35 of them,
covering radius 3 + 3 + 1 + 3). Two fingerprints at most two bits apart have a
point between them at most one bit from either, and that point has one nearest
anchor. So a fingerprint goes to the anchors of the points at most one bit
away, all within the covering radius plus the threshold, and the two are found
together at one of them. At an anchor only fingerprints with a common such
point link, each to the smallest: linear in the anchor's rows, never all pairs.
An anchor with very many rows is split by those points themselves, each of
which at most 65 fingerprints reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, stash, text_rows, texts_of

SEED = 42
#: Names that no input column has.
GONE, GONE_ROW, ROW = "__newslode_gone", "__newslode_gone_row", "__newslode_row"
#: Generator polynomials of the binary Golay code (23, 12) and the Hamming code (15, 11) (fixed values).
GOLAY, HAMMING = 0b110001110101, 0b10011
BLOCKS = ((0, 23, GOLAY, 11, 3), (23, 23, GOLAY, 11, 3), (46, 15, HAMMING, 4, 1))
FREE = 3
#: Rows of an anchor beyond which it is split.
SPLIT_ROWS = 50_000


def shingle_hashes(text: str, size: int = 3) -> np.ndarray:
    words = b" ".join(text.encode().lower().split())
    if not words:
        return np.zeros(0, np.uint64)
    gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(words)]
    h = xxhash.xxh64_intdigest
    return np.array([h(words[a:b], SEED) for a, b in zip(starts, ends[size - 1 :])] or [h(words, SEED)], np.uint64)


def fingerprint(text: str | None) -> int:
    """64 bits: each set if it is set in over half of the shingles' hashes; 0 without words."""
    h = shingle_hashes(text or "")
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 100_000):
        part = h[i : i + 100_000].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, row (hash of the text), fp (the 64 bits as a signed long), a row for each row of docs."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("fp", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fp = np.array([fingerprint(t) for t in texts_of(b.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(fp)], schema=schema)

    return text_rows(docs).withColumn("row", F.xxhash64("text")).mapInArrow(run, "doc_id long, row long, fp long")


class Anchors:
    """Nearest code words by syndrome."""

    def __init__(self) -> None:
        self.blocks = []
        for shift, bits, poly, redundancy, radius in BLOCKS:
            syndromes = np.zeros(bits, np.int64)
            for i in range(bits):
                r = 1 << i
                for k in range(bits - 1, redundancy - 1, -1):
                    if r >> k & 1:
                        r ^= poly << (k - redundancy)
                syndromes[i] = r
            leader = np.zeros(1 << redundancy, np.int64)
            errors = [(0, 0, -1)]
            for _ in range(radius):
                errors = [(e | 1 << i, s ^ int(syndromes[i]), i) for e, s, last in errors for i in range(last + 1, bits)]
                for e, s, _last in errors:
                    leader[s] = e
            half = bits // 2
            low = np.zeros(1 << half, np.int64)
            high = np.zeros(1 << (bits - half), np.int64)
            for to, at in ((low, 0), (high, half)):
                for i in range(len(to).bit_length() - 1):
                    to[1 << i : 2 << i] = to[: 1 << i] ^ syndromes[at + i]
            self.blocks.append((shift, bits, half, low, high, leader))

    def nearest(self, points: np.ndarray) -> np.ndarray:
        """Of each 64-bit point its anchor, as 61 bits."""
        out = np.zeros(points.shape, np.int64)
        for shift, bits, half, low, high, leader in self.blocks:
            x = (points >> np.uint64(shift)).astype(np.int64) & ((1 << bits) - 1)
            out |= (x ^ leader[low[x & ((1 << half) - 1)] ^ high[x >> half]]) << shift
        return out


def around(fp: np.ndarray) -> np.ndarray:
    """The point itself and the 64 at one bit from it: a row for each."""
    flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
    return fp[:, None] ^ flips[None, :]


def to_anchors(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    code = Anchors()
    for b in it:
        fps = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for i in range(0, len(fps), 50_000):
            own = fps[i : i + 50_000]
            at = np.sort(code.nearest(around(own)), axis=1)
            new = np.ones(at.shape, bool)
            new[:, 1:] = at[:, 1:] != at[:, :-1]
            yield pa.RecordBatch.from_arrays([pa.array(at[new]), pa.array(np.repeat(own, new.sum(1)).view(np.int64))], names=["bucket", "fp"])


def to_points(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows of split anchors: a row for each point of theirs at that anchor, which becomes the bucket."""
    code = Anchors()
    for b in it:
        fps, at = (b.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "bucket"))
        for i in range(0, len(fps), 50_000):
            z = around(fps[i : i + 50_000].view(np.uint64))
            row, col = np.nonzero(code.nearest(z) == at[i : i + 50_000, None])
            yield pa.RecordBatch.from_arrays([pa.array(z[row, col].view(np.int64)), pa.array(fps[i : i + 50_000][row])], names=["bucket", "fp"])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links in, links of each node to the smallest of its component out: no more than there are nodes."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        np.minimum.at(root, before[x], low)
        np.minimum.at(root, before[y], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            break
    linked = root != np.arange(len(nodes))
    return nodes[linked], nodes[root[linked]]


def link_buckets(whole: bool):
    """Rows sorted by bucket in, links out. whole: the bucket is an anchor, compare by the points; else it is such a point."""

    def links(bucket: np.ndarray, fp: np.ndarray, code: Anchors) -> tuple[np.ndarray, np.ndarray]:
        if whole:
            alone = np.ones(len(bucket), bool)
            same = bucket[1:] == bucket[:-1]
            alone[1:] &= ~same
            alone[:-1] &= ~same
            bucket, fp = bucket[~alone], fp[~alone]
            found = []
            for i in range(0, len(fp), 50_000):
                z = around(fp[i : i + 50_000].view(np.uint64))
                row, col = np.nonzero(code.nearest(z) == bucket[i : i + 50_000, None])
                found.append((z[row, col].view(np.int64), fp[i : i + 50_000][row]))
            bucket, fp = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (bucket, fp)
        order = np.lexsort((fp, bucket))
        bucket, fp = bucket[order], fp[order]
        first = np.ones(len(fp), bool)
        first[1:] = bucket[1:] != bucket[:-1]
        least = fp[np.maximum.accumulate(np.where(first, np.arange(len(fp)), 0))]
        return forest(fp[fp != least], least[fp != least])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, rest = Anchors(), (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for b in it:
            bucket, fp = (np.concatenate([r, b.column(c).to_numpy(zero_copy_only=False)]) for r, c in zip(rest, ("bucket", "fp"), strict=True))
            if not len(bucket):
                continue
            cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on in the next batch
            x, y = links(bucket[:cut], fp[:cut], code)
            rest = bucket[cut:], fp[cut:]
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])
        x, y = links(*rest, code)
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

    return run


def link_forest(fps: DataFrame) -> DataFrame:
    """Distinct fp in; links (a, b), b < a, whose components are those of all pairs at most two bits apart."""
    rows = stash(fps.mapInArrow(to_anchors, "bucket long, fp long"), "anchors")
    # A table, since its size grows with the rows: a row for every SPLIT_ROWS of them at most.
    heavy = rows.groupBy("bucket").count().where(F.col("count") > SPLIT_ROWS).select("bucket")

    def at(df: DataFrame, whole: bool) -> DataFrame:
        n = partitions_for(df)
        return df.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(link_buckets(whole), "a long, b long")

    if heavy.isEmpty():
        return at(rows, True)
    split = stash(heavy, "split-anchors")
    return at(rows.join(split, "bucket", "left_anti"), True).unionByName(at(rows.join(split, "bucket", "left_semi").mapInArrow(to_points, "bucket long, fp long"), False))


def local_forest(df: DataFrame) -> DataFrame:
    """Each task replaces its links by a forest of the same components."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = y = np.zeros(0, np.int64)
        for b in it:
            x, y = forest(*(np.concatenate([old, b.column(c).to_numpy(zero_copy_only=False)]) for old, c in ((x, "a"), (y, "b"))))
            if len(x) > 2_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])
                x = y = np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

    return df.mapInArrow(run, "a long, b long")


def components(links: DataFrame, name: str = "links", most_rounds: int = 100) -> DataFrame:
    """Links (a, b) in; node, root out: the smallest node of its component, for every node that isn't its own root.

    Each round links every node's larger neighbours, then the node itself, to its smallest
    neighbour; the rounds grow with the logarithm of the longest path. Aggregates
    combine before they shuffle, and joins on a node with many links can be split. Links that
    are not settled after most_rounds are an error, never a result.
    """
    now = stash(local_forest(links).distinct(), name)

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    seen = state(now)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        larger = now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        # links u - v with v > u: v goes to the smallest neighbour of u
        large = larger.join(least, larger.u == least.a).select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down.withColumnRenamed("a", "u"), F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        now = stash(local_forest(small.unionByName(down.withColumnRenamed("m", "b"))).distinct(), name)
        if (after := state(now)) == seen:
            break
        seen = after
    else:
        raise RuntimeError(f"links are not settled after {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, row (hash of the text), fp, component_id (smallest doc_id reachable by links of at most two bits).

    Null and empty texts have fingerprint 0 and link like any other. Equal
    fingerprints are one node, so a group of copies costs one row. Repeated
    rows return as often as they come; null ids join a component but never name it
    unless nothing else does.
    """
    prints = stash(fingerprints(docs), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    # Written between, since a task that goes through Python twice leaves its executor two workers.
    found = components(stash(link_forest(classes.select("fp")), "forest"))
    rooted = classes.join(found, classes.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    final = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(final, "fp").select("doc_id", "row", "fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs without all but the smallest doc_id of each component.

    A row goes by its id and its text: where an id stands with two texts, the one that is nobody's near copy stays.
    Repeated rows of the id that stays are one document and stay; rows with a null id stay; null and empty texts are copies of each other.
    """
    gone = near_duplicates(docs).where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(GONE), F.col("row").alias(GONE_ROW)).distinct()
    own = docs.withColumn(ROW, F.xxhash64(F.col("text").cast("string")))
    return own.join(gone.hint("merge"), (F.col("doc_id") == F.col(GONE)) & (F.col(ROW) == F.col(GONE_ROW)), "left_anti").select(*docs.columns)
