"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded stretch of documents inside a task. Its words become
symbols: a number for each benchmark word, none for the others. Runs of benchmark words
at least as long as the shortest window are the shard's sequence; its suffix
array gives the Burrows-Wheeler transform, whose ranks a wavelet matrix
answers. All windows of the benchmark are searched backwards at once; their
occurrences are located from sampled suffix positions; what they cover is
merged into removal spans per document.

The benchmark comes to the shards in blocks of bounded size (BLOCK_BYTES of
text); with several blocks each is a pass of its own over the documents and
the spans are merged per document.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, buffer_of, byte_table, hex_digest, rows_of, spans, text_rows, word_hashes

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: Benchmark text in one broadcast.
BLOCK_BYTES = 4_000_000
#: Bytes of text in a shard.
SHARD_BYTES = 5_000_000
#: A suffix position is kept for each of so many positions of a shard's sequence.
SAMPLE = 8


class Phrases:
    """The windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[int | None, str]], size: int):
        # Items go by number; their ids, one of which may be null, come back at the end.
        ids = sorted({i for i, _ in items}, key=lambda i: (i is None, i or 0))
        self.ids, place = pa.array(ids, pa.int64()), {i: n for n, i in enumerate(ids)}
        words = [(place[i], WORD.findall(t.encode().lower())) for i, t in items]
        vocabulary = sorted({w for _, ws in words for w in ws})
        number = {w: n for n, w in enumerate(vocabulary, 1)}
        held: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for item, ws in words:
            own = [number[w] for w in ws]
            for k in range(max(1, len(own) - size + 1) if own else 0):
                held[tuple(own[k : k + size])].add(item)
        self.symbols = len(vocabulary)
        buf = np.frombuffer(b"".join(vocabulary), np.uint8)
        ends = np.cumsum([len(w) for w in vocabulary], dtype=np.int64)
        starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]]) if len(ends) else ends
        first, second = word_hashes(buf, starts, ends), word_hashes(buf, starts, ends, seed=1)
        order = np.argsort(first)
        self.hash, self.check, self.number = first[order], second[order], (order + 1).astype(np.int32)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[first >> np.uint64(44)] = True
        by_length: dict[int, list] = defaultdict(list)
        for w, i in held.items():
            by_length[len(w)].append((w, sorted(i)))
        self.windows = {n: (np.array([w for w, _ in x], np.int32), [np.array(i, np.int64) for _, i in x]) for n, x in sorted(by_length.items())}
        self.shortest = min(self.windows, default=0)

    def symbols_of(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each word, 0 for those in no item. Two 64-bit hashes have to agree."""
        h = word_hashes(low, start, end)
        out = np.zeros(len(h), np.int32)
        at = np.flatnonzero(self.maybe[h >> np.uint64(44)])
        place = np.minimum(np.searchsorted(self.hash, h[at]), len(self.hash) - 1)
        hit = self.hash[place] == h[at]
        at, place = at[hit], place[hit]
        out[at] = self.number[place]
        self.place = place, at
        return out


class FMIndex:
    """Of a sequence of numbers from 1; 0 separates runs."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        text = np.append(sequence, 0).astype(np.int64)
        n = self.n = len(text)
        rank = np.append(text[:-1] + 1, 0)  # the end is the smallest
        order = np.argsort(rank, kind="stable")
        step = 1
        while True:
            key = rank * (n + symbols + 3)
            key[: n - step] += rank[step:] + 1
            order = np.argsort(key, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank = new
            step *= 2
            if rank[order[-1]] == n - 1 or step >= n:
                break
        shifted = np.append(text[:-1], symbols + 1)  # the end gets a symbol of its own, which nothing searches
        last = shifted[order - 1]
        self.first = np.zeros(symbols + 3, np.int64)
        np.cumsum(np.bincount(shifted, minlength=symbols + 2), out=self.first[1:])
        # The end stands first in the order of suffixes, whatever its symbol.
        self.first[: symbols + 1] += 1
        self.first[symbols + 1] = 0
        self.levels = []
        now = last
        for bit in range((symbols + 1).bit_length() - 1, -1, -1):
            ones = (now >> bit & 1).astype(bool)
            zeros = np.concatenate([np.zeros(1, np.int64), np.cumsum(~ones)])
            self.levels.append((bit, zeros))
            now = np.concatenate([now[~ones], now[ones]])
        sampled = order % SAMPLE == 0
        self.sampled, self.sampled_before = sampled, np.cumsum(sampled) - sampled
        self.samples = order[sampled]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each row of the transform."""
        low = np.zeros(len(row), np.int64)
        at = row
        for bit, zeros in self.levels:
            one = (symbol >> bit & 1).astype(bool)
            a, z = zeros[at], zeros[low]
            at, low = np.where(one, zeros[-1] + at - a, a), np.where(one, zeros[-1] + low - z, z)
        return at - low

    def symbol(self, row: np.ndarray) -> np.ndarray:
        at, out = row, np.zeros(len(row), np.int64)
        for bit, zeros in self.levels:
            a = zeros[at]
            one = zeros[at + 1] == a
            out |= one.astype(np.int64) << bit
            at = np.where(one, zeros[-1] + at - a, a)
        return out

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes that begin with each phrase: from and to."""
        low, high = np.zeros(len(words), np.int64), np.full(len(words), self.n, np.int64)
        live = np.arange(len(words))
        for k in range(words.shape[1] - 1, -1, -1):
            c = words[live, k].astype(np.int64)
            low[live] = self.first[c] + self.rank(c, low[live])
            high[live] = self.first[c] + self.rank(c, high[live])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        return low, np.maximum(low, high)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Positions of suffixes: walk back to the nearest sampled one."""
        out, steps = np.zeros(len(row), np.int64), 0
        todo = np.arange(len(row))
        while len(todo):
            here = self.sampled[row]
            out[todo[here]] = self.samples[self.sampled_before[row[here]]] + steps
            todo, row = todo[~here], row[~here]
            c = self.symbol(row)
            row = self.first[c] + self.rank(c, row)
            steps += 1
        return out % self.n


def shard_hits(low: np.ndarray, offsets: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words per document; (document, number of the item) of every occurring window; hit words as an array over all words; the document of each word."""
    start, end = spans(low, offsets)
    n_docs = len(offsets) - 1
    doc = rows_of(start, offsets)
    words = np.bincount(doc, minlength=n_docs)
    hit = np.zeros(len(start) + 1, np.int64)
    pairs = np.zeros((0, 2), np.int64)
    if not phrases.windows or not len(start):
        return words, pairs, hit[:-1] > 0, doc
    sym = phrases.symbols_of(low, start, end)
    # Runs of benchmark words inside one document.
    known = sym > 0
    edge = np.ones(len(sym), bool)
    edge[1:] = ~known[1:] | ~known[:-1] | (doc[1:] != doc[:-1])
    run = np.cumsum(edge) - 1
    long = np.bincount(run, weights=known)[run] >= phrases.shortest
    keep = np.flatnonzero(known & long)
    # The second hash has to agree as well; a word that doesn't is none of the benchmark's.
    place, at = phrases.place
    chosen = np.isin(at, keep, assume_unique=True)
    wrong = at[chosen][word_hashes(low, start[at[chosen]], end[at[chosen]], seed=1) != phrases.check[place[chosen]]]
    if len(wrong):
        keep = np.setdiff1d(keep, wrong)
    if not len(keep):
        return words, pairs, hit[:-1] > 0, doc
    gap = np.ones(len(keep), bool)
    gap[1:] = (keep[1:] != keep[:-1] + 1) | (doc[keep[1:]] != doc[keep[:-1]])
    # A 0 before each run; origin leads back to the word.
    place = np.arange(len(keep)) + np.cumsum(gap)
    sequence, origin = np.zeros(place[-1] + 1, np.int32), np.full(place[-1] + 1, -1, np.int64)
    sequence[place], origin[place] = sym[keep], keep
    index = FMIndex(sequence, phrases.symbols)
    found = []
    for n, (windows, items) in phrases.windows.items():
        a, b = index.search(windows)
        for w in np.flatnonzero(a < b):
            word = origin[index.locate(np.arange(a[w], b[w]))]
            np.add.at(hit, word, 1)
            np.add.at(hit, word + n, -1)
            docs = np.unique(doc[word])
            found.append(np.stack([np.repeat(docs, len(items[w])), np.tile(items[w], len(docs))], 1))
    if found:
        pairs = np.unique(np.concatenate(found), axis=0)
    return words, pairs, np.cumsum(hit)[:-1] > 0, doc


HITS = "doc_id long, row long, n_words long, begin array<int>, until array<int>, items array<long>"


def finder(block):
    to = byte_table(SEPARATORS)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = block.value
        for b in batches(it, SHARD_BYTES):
            data, offsets = buffer_of(b.column("text"))
            words, pairs, hit, doc = shard_hits(to[data], offsets, phrases)
            n = b.num_rows
            # Covered words as spans, in word positions of their document.
            before = np.concatenate([np.zeros(1, np.int64), np.cumsum(words)])
            turn = np.zeros(len(hit), bool)
            turn[:1] = hit[:1]
            turn[1:] = hit[1:] & (~hit[:-1] | (doc[1:] != doc[:-1]))
            stop = np.zeros(len(hit), bool)
            stop[-1:] = hit[-1:]
            stop[:-1] |= hit[:-1] & (~hit[1:] | (doc[1:] != doc[:-1]))
            first, last = np.flatnonzero(turn), np.flatnonzero(stop)
            edges = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bincount(doc[first], minlength=n))]).astype(np.int32)
            item_edges = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bincount(pairs[:, 0], minlength=n))]).astype(np.int32)
            as_list = lambda v, e: pa.ListArray.from_arrays(pa.array(e), pa.array(v))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row"), pa.array(words), as_list((first - before[doc[first]]).astype(np.int32), edges), as_list((last + 1 - before[doc[last]]).astype(np.int32), edges), pa.ListArray.from_arrays(pa.array(item_edges), phrases.ids.take(pa.array(pairs[:, 1])))],
                names=["doc_id", "row", "n_words", "begin", "until", "items"],
            )

    return run


def merge_spans(begin: list[int], until: list[int]) -> list[tuple[int, int]]:
    """Overlapping and touching spans become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(begin, until, strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find(docs: DataFrame, benchmark: DataFrame, size: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, row (hash of the text), n_words, begin and until (spans in words), items, for each row of docs.

    Null and empty texts have no words and no hits; an item without words has
    no window; repeated rows each return; ids of documents and items may be null; other columns play no part.
    """
    spark = docs.sparkSession
    rows = text_rows(docs).withColumn("row", F.xxhash64("text"))
    items, n = blocks_of(benchmark, block_bytes)
    found = []
    for k in range(n):
        block = spark.sparkContext.broadcast(phrases_of(items, k, n, size))
        found.append(rows.mapInArrow(finder(block), HITS))
    if n == 1:
        return found[0]
    hits = found[0]
    for x in found[1:]:
        hits = hits.unionByName(x)
    flat = lambda c: F.flatten(F.collect_list(c)).alias(c)
    merged = hits.where(F.size("items") > 0).groupBy("doc_id", "row").agg(flat("begin"), flat("until"), flat("items"))
    left = found[0].select("doc_id", "row", "n_words")
    none = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
    return left.join(merged, left.doc_id.eqNullSafe(merged.doc_id) & (left.row == merged.row), "left").select(left.doc_id, left.row, "n_words", none("begin", "int"), none("until", "int"), none("items", "long"))


def report(docs: DataFrame, benchmark: DataFrame, size: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, begin, until; a row for each row of docs.

    Items without an id count as one item, which has no part in the digest.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = hex_digest(b"")
        for b in it:
            out: tuple[list, ...] = ([], [], [], [], [], [], [], [])
            cols = [b.column(c).to_pylist() for c in ("doc_id", "row", "n_words", "begin", "until", "items")]
            for doc, row, words, begin, until, items in zip(*cols, strict=True):
                merged = merge_spans(begin, until) if begin else []
                hit = sum(y - x for x, y in merged)
                distinct = set(items) if items else set()
                names = sorted(str(i) for i in distinct if i is not None)
                digest = hex_digest(",".join(names).encode()) if names else empty
                for c, v in zip(out, (doc, row, words, hit, len(distinct), digest, hit > 0 and 20 * hit >= words, [list(x) for x in merged]), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["doc_id", "row", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.list_(pa.int32()))]
    return find(docs, benchmark, size, block_bytes).mapInArrow(run, "doc_id long, row long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<array<int>>")


def blocks_of(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Items with a text, and the number of blocks that hold about block_bytes each."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return items, max(1, -(-size // block_bytes))


def phrases_of(items: DataFrame, k: int, n: int, size: int) -> Phrases:
    """The k-th of n blocks: a bounded number of bytes, dealt by hash."""
    return Phrases([tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()], size)


def clean(docs: DataFrame, benchmark: DataFrame, size: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without the contaminated rows, in which at least a twentieth of the words is hit.

    With one block rows are judged where they are; with several, the contaminated rows' ids and
    text hashes are taken out by an anti join. Null ids are equal in it, so the result is the same.
    """
    items, n = blocks_of(benchmark, block_bytes)
    if n == 1:
        block = docs.sparkSession.sparkContext.broadcast(phrases_of(items, 0, 1, size))
        at, to = docs.columns.index("text"), byte_table(SEPARATORS)

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches(it, SHARD_BYTES):
                data, offsets = buffer_of(b.column(at))
                words, _, hit, doc = shard_hits(to[data], offsets, block.value)
                hits = np.bincount(doc, weights=hit, minlength=b.num_rows)
                yield b.filter(pa.array((hits == 0) | (20 * hits < words)))

        return docs.mapInArrow(run, docs.schema)
    bad = report(docs, benchmark, size, block_bytes).where("contaminated").select(F.col("doc_id").alias("__newslode_bad"), F.col("row").alias("__newslode_bad_row")).distinct().hint("merge")
    own = docs.withColumn("__newslode_row", F.xxhash64(F.col("text").cast("string")))
    return own.join(bad, F.col("doc_id").eqNullSafe(F.col("__newslode_bad")) & (F.col("__newslode_row") == F.col("__newslode_bad_row")), "left_anti").select(*docs.columns)
