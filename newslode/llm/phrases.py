"""Phrase collocation mining by dynamic itemset counting.

The texts are cut into a few shards that are scanned one after another, round and
round. Words are counted from the first scan on. As soon as a phrase's two
subphrases (all but its last word, all but its first) have reached the threshold,
after whatever scan, the next scan counts the phrase as well, so that phrases of
all lengths are counted side by side; a phrase is complete when every shard has
been scanned since, which is one full cycle for it.

A scan leaves a table of counts. What a phrase has in the last cycle of scans is its
count so far; it can only have reached the threshold if one of those scans gave it
that threshold's share, so only phrases with such a scan are summed up. Of a phrase's last scan only what can matter is written: counts of that
share, or of phrases that had it before in the cycle. Tables of scans before the last cycle are deleted. What has
reached the threshold goes to the scans as Bloom filters of fixed size: everything,
what was new within the last cycle (a phrase with no new subphrase is complete), and what was new in it but for its first scan
(a phrase with no such subphrase is scanned for the last time).
A false hit costs work and never a result: a phrase that is counted without need has
too few occurrences, and a cycle of scans has each shard once.

Phrases are told apart by 125 bits of their words' 64-bit hashes. At the end the
hashes of the words of the frequent ones are looked up in the shards, and those of the words
themselves in the texts, where a second hash of every occurrence shows if two words were taken for
one. (Two phrases of different words and one key of 125 bits would be noticed where they are looked up.)
Only what is returned is put into words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_bytes, batches, buffer_of, discard, partitions_for, rows_of, setting, spans, stash, word_hashes

LONGEST = 5
SHARDS = 2
#: Bits of a filter (8 MB), and how many of them a phrase sets, all in one block (a line of the cache).
BITS, HASHES = 2**26, 3
SLICE_BITS, BLOCK_BITS = 2**19, 512
#: Bytes of text of a batch, and of hashes of a buffer.
BATCH, BUFFER = 1_000_000, 2_500_000
#: Names a task remembers (16 MB), and one task in how many looks for a phrase first.
REMEMBERED, TURNS = 2_000_000, 8
#: Rows of tokens() are large (some 0.1 to 1.6 MB): the size of a page is looked at after each row and not after 100, and few rows are read at once.
#: Row groups stay large, since counts combine in a task: with more of them more is shuffled.
WRITTEN = {"parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false"}
READ = ("spark.sql.parquet.columnarReaderBatchSize", "16")
HASHED = [f"h{i + 1}" for i in range(LONGEST)]
RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
SPACE, END = b" \t", b".,;:!?\n\x0b\x0c\r"
ONE, TWO = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))


class HashClash(ValueError):
    """Two words of one hash, at least one of them in a frequent phrase."""


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[0] = 0xFF  # a NUL is part of a word; this byte is in no UTF-8
    table[np.frombuffer(SPACE + END, np.uint8)] = 0
    return table


class Words:
    """The words of a batch in order, and for each whether it begins a piece."""

    def __init__(self, b: pa.RecordBatch, seed: int) -> None:
        data, offsets = buffer_of(b.column("text"))
        self.low = _lower()[data]
        self.start, self.end = spans(self.low, offsets)
        self.hash = word_hashes(self.low, self.start, self.end, seed)
        self.hash[self.hash == 0] = 1
        self.row = rows_of(self.start, offsets)
        ends = np.zeros(256, bool)
        ends[np.frombuffer(END, np.uint8)] = True
        breaks = np.searchsorted(np.flatnonzero(ends[data]), self.start)
        self.new = np.ones(len(self.start), bool)
        self.new[1:] = (self.row[1:] != self.row[:-1]) | (breaks[1:] != breaks[:-1])
        kinds, lang = np.unique(np.array(b.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        self.langs, self.lang = [str(x) for x in kinds], lang[self.row]


def tokens(docs: DataFrame, shards: int, seed: int) -> DataFrame:
    """shard, lang, words (64 bits a word, 0 before each piece), n (words)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 0
        for b in batches(it, BATCH):
            w = Words(b, seed)
            group = w.lang * shards + (row + w.row) % shards
            row += b.num_rows
            out = []
            for g in np.unique(group).tolist():
                own = group == g
                out.append((g % shards, w.langs[g // shards], np.insert(w.hash[own], np.flatnonzero(w.new[own]), 0).tobytes(), int(own.sum())))
            if out:
                kinds = (pa.int32(), pa.string(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["shard", "lang", "words", "n"])

    return _texts(docs).mapInArrow(run, "shard int, lang string, words binary, n long")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))


def _begin(lang: str) -> tuple[np.uint64, np.uint64]:
    a, b = np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=16).digest(), np.uint64)
    return a, b


def _mixed(x: np.ndarray, w: np.ndarray, by: np.uint64) -> np.ndarray:
    return ((x ^ (x >> np.uint64(31))) * by) ^ (w * (ONE if by == TWO else TWO))


def _key2(x: np.ndarray, size: int) -> np.ndarray:
    """The second part of a phrase's key; its size in the last three bits."""
    return (x ^ (x >> np.uint64(29))) << np.uint64(3) | np.uint64(size)


def _at(key: np.ndarray, bits: int) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """The first bit of a key's block in a filter, and the bits it sets there."""
    x = key * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    base = ((x >> np.uint64(32)) % np.uint64(max(1, bits // BLOCK_BITS))).astype(np.int64) * BLOCK_BITS
    return base, (((x >> np.uint64(9 * i)) & np.uint64(min(bits, BLOCK_BITS) - 1)).astype(np.int64) for i in range(HASHES))


class Filters:
    """Bloom filters of keys, by number. Packed where it travels."""

    def __init__(self, bits: int, slices: list) -> None:
        self.bits, self.slices, self.tables = bits, [(r.which, r.slice, bytes(r.data)) for r in slices], None

    def __getstate__(self) -> dict:
        return {"bits": self.bits, "slices": self.slices, "tables": None}

    def has(self, which: int, key: np.ndarray) -> np.ndarray:
        """Whether each key may be known; bits after the first are looked up for what is left only."""
        if self.tables is None:
            self.tables = [np.zeros(max(1, self.bits // 8), np.uint8) for _ in range(3)]
            for w, s, data in self.slices:
                part = np.frombuffer(zlib.decompress(data), np.uint8)
                self.tables[w][s * SLICE_BITS // 8 :][: len(part)] = part
            self.slices = []
        table = self.tables[which]
        left = None
        base, places = _at(key, self.bits)
        for b in places:
            at = base + b if left is None else base[left] + b[left]
            hit = table[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
            left = np.flatnonzero(hit) if left is None else left[hit]
        found = np.zeros(len(key), bool)
        found[left] = True
        return found


def filters(keys: DataFrame, bits: int) -> Filters | None:
    """Filters of the keys k1 (number 0), of those marked new (number 1), and where there is such a column newer (number 2); None if none is new. A slice is made by one task; what comes to the driver is the filters."""
    slices = max(1, bits // SLICE_BITS)
    if "newer" not in keys.columns:
        keys = keys.withColumn("newer", F.lit(False))

    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            key = b.column("k1").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array((_at(key.view(np.uint64), bits)[0] // SLICE_BITS).astype(np.int32)), pa.array(key), b.column("new"), b.column("newer")], names=["slice", "k1", "new", "newer"])

    def make(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[tuple[int, int], np.ndarray] = {}
        for b in it:
            at, key, new, newer = (b.column(c).to_numpy(zero_copy_only=False) for c in ("slice", "k1", "new", "newer"))
            for s in np.unique(at).tolist():
                for which, own in ((0, at == s), (1, (at == s) & new), (2, (at == s) & newer)):
                    if own.any():
                        table = tables.setdefault((which, s), np.zeros(min(SLICE_BITS, bits), bool))
                        base, places = _at(key[own].view(np.uint64), bits)
                        for place in places:
                            table[base % SLICE_BITS + place] = True
            while len(tables) > 64:  # sorted by slice: what came first is over
                (which, s), table = next(iter(tables.items()))
                if s == at[-1]:
                    break
                del tables[which, s]
                yield row(which, s, table)
        for (which, s), table in tables.items():
            yield row(which, s, table)

    def row(which: int, s: int, table: np.ndarray) -> pa.RecordBatch:
        data = zlib.compress(np.packbits(table, bitorder="little").tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([which], pa.int32()), pa.array([s], pa.int32()), pa.array([data], pa.binary())], names=["which", "slice", "data"])

    dealt = keys.select("k1", "new", "newer").mapInArrow(deal, "slice int, k1 long, new boolean, newer boolean")
    if slices > 1:
        dealt = dealt.repartition(min(slices, partitions_for(keys)), "slice").sortWithinPartitions("slice")
    else:
        dealt = dealt.coalesce(1)
    parts = dealt.mapInArrow(make, "which int, slice int, data binary").collect()
    return Filters(bits, parts) if any(r.which for r in parts) else None


def _active(lang: str, h: np.ndarray, known: Filters | None, words_too: bool, all_of: bool = False, more_words: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]:
    """Of a sequence of words its active phrases: their size, starts and keys, and whether the next scan counts them too (words: more_words). all_of: the known phrases themselves."""
    at = np.flatnonzero(h)
    first, second = (_mixed(np.full(1, x), np.zeros(1, np.uint64), by)[0] for x, by in zip(_begin(lang), (ONE, TWO), strict=True))
    one = h[at] * TWO ^ first
    if words_too:
        yield 1, at, one, _key2(h[at] * ONE ^ second, 1), np.full(len(at), more_words)
    if known is None:
        return
    keep = known.has(0, one)
    at, one = at[keep], one[keep]
    two = h[at] * ONE ^ second
    padded = np.append(h, np.uint64(0))
    for size in range(2, LONGEST + 2):
        if size > 2:
            keep = known.has(0, one)
            at, one, two = at[keep], one[keep], two[keep]
        if all_of and len(at):
            yield size - 1, at, one, _key2(two, size - 1), None
        if not len(at) or size > LONGEST:
            return
        both = np.flatnonzero(at[1:] == at[:-1] + 1)
        if not all_of:
            new = known.has(1, one)
            fresh = new[both] | new[both + 1]
            new[new] = known.has(2, one[new])
            more = new[both] | new[both + 1]
        at = at[both]
        last = padded[at + size - 1]
        one, two = _mixed(one[both], last, ONE), _mixed(two[both], last, TWO)
        # A phrase of old parts is complete, but a longer one may begin with it.
        if not all_of:
            yield size, at[fresh], one[fresh], _key2(two[fresh], size), more[fresh]


def buffers(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
    """Rows of tokens() put together, those of a language, up to BUFFER bytes."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for b in it:
        for i in range(b.num_rows):
            lang, words = b.column("lang")[i].as_py(), b.column("words")[i].as_py()
            held.setdefault(lang, []).append(words)
            size += len(words)
            if size > BUFFER:
                yield from ((g, np.frombuffer(b"".join(parts), np.uint64)) for g, parts in held.items())
                held, size = {}, 0
    yield from ((g, np.frombuffer(b"".join(parts), np.uint64)) for g, parts in held.items())


def counted(shard: DataFrame, spread: Broadcast | None, words_too: bool, more_words: bool) -> DataFrame:
    """k1, k2, n: occurrences of the active phrases in a part of a shard, below 0 if this is their last scan. spread: the filters of what is known."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, h in buffers(it):
            for _, _, one, two, more in _active(lang, h, spread and spread.value, words_too, more_words=more_words):
                order = np.argsort(one)
                one, two, more = one[order], two[order], more[order]
                new = np.ones(len(one), bool)
                new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(one))) * np.where(more[first], 1, -1)
                for s in range(0, len(n), 200_000):
                    p = slice(s, s + 200_000)
                    yield pa.RecordBatch.from_arrays([pa.array(one[first[p]].view(np.int64)), pa.array(two[first[p]].view(np.int64)), pa.array(n[p])], names=["k1", "k2", "n"])

    return shard.select("lang", "words").mapInArrow(run, "k1 long, k2 long, n long")


def passing(rows: DataFrame, spread: Broadcast) -> DataFrame:
    """The rows whose key is in filter 0."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield b.filter(pa.array(spread.value.has(0, b.column("k1").to_numpy(zero_copy_only=False).view(np.uint64))))

    return rows.mapInArrow(run, "k1 long, k2 long, n long")


def telling(rows: DataFrame, share: int, spread: Broadcast | None) -> DataFrame:
    """Of a scan's counts those that may be part of a sum at the threshold, all above 0: of phrases in their last scan those of the share, or of phrases that had it before (spread)."""
    if spread is None:
        return rows.where((F.col("n") > 0) | (F.col("n") <= -share)).withColumn("n", F.abs("n"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            n = b.column("n").to_numpy(zero_copy_only=False)
            own = (n > 0) | (n <= -share)
            rest = np.flatnonzero(~own)
            own[rest] = spread.value.has(0, b.column("k1").to_numpy(zero_copy_only=False)[rest].view(np.uint64))
            kept = b.filter(pa.array(own))
            yield pa.RecordBatch.from_arrays([kept.column("k1"), kept.column("k2"), pa.array(np.abs(n[own]))], names=["k1", "k2", "n"])

    return rows.mapInArrow(run, "k1 long, k2 long, n long")


def frequent(rows: DataFrame, threshold: int, shards: int, bits: int = BITS) -> DataFrame:
    """k1, k2, f: every phrase of up to five words with f >= threshold. rows: those of tokens()."""
    cycle: list[DataFrame] = []
    share = -(-threshold // shards)
    reached: DataFrame | None = None
    known, scan = None, 0
    spread = rows.sparkSession.sparkContext.broadcast

    def hopeful_of(scans: list[DataFrame]) -> Broadcast | None:
        """The keys that have the share in one of the scans."""
        made = filters(reduce(DataFrame.unionByName, scans).where(F.col("n") >= share).select("k1", F.lit(True).alias("new")), bits) if scans else None
        return None if made is None else spread(made)

    while scan < shards or known is not None:
        if len(cycle) == shards:  # the same shard; what was found in it is written
            discard(cycle.pop(0))
        before = hopeful_of(cycle)
        new = counted(rows.where(F.col("shard") == scan % shards), known, scan < shards, scan < shards - 1).groupBy("k1", "k2").agg(F.sum("n").alias("n"))
        with setting(rows.sparkSession, *READ):
            cycle.append(stash(telling(new, share, before), "phrase-counts"))
        for x in (known, before):
            if x is not None:
                x.destroy()
        hopeful = hopeful_of(cycle)
        if hopeful is not None:
            counts = reduce(DataFrame.unionByName, cycle)
            found = passing(counts, hopeful).groupBy("k1", "k2").agg(F.sum("n").alias("f")).where(F.col("f") >= threshold).withColumn("reach", F.lit(scan))
            if reached is not None:
                found = found.unionByName(reached).groupBy("k1", "k2").agg(F.max("f").alias("f"), F.min("reach").alias("reach"))
            found = stash(found, "phrases")
            if reached is not None:
                discard(reached)
            reached = found
            hopeful.destroy()
        scan += 1
        found = None if reached is None else filters(reached.where(f"k2 & 7 < {LONGEST}").select("k1", (F.col("reach") >= scan - shards).alias("new"), (F.col("reach") > scan - shards).alias("newer")), bits)
        known = None if found is None else spread(found)
    for c in cycle:
        discard(c)
    if reached is None:
        return rows.sparkSession.createDataFrame([], "k1 long, k2 long, f long")
    return reached.select("k1", "k2", "f")


def sequences(rows: DataFrame, spread: Broadcast, turns: int) -> DataFrame:
    """k1, k2, lang, check, h1 to h5: the words' hashes of known phrases, each at most once from a task as long as it remembers.

    turns: a task gives the phrases whose turn it is by their key and its number, one in so many; with 0, each gives those in filter 1."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = np.uint64(TaskContext.get().partitionId() % max(1, turns))
        seen = np.zeros(0, np.uint64)
        for lang, h in buffers(it):
            padded = np.append(h, np.zeros(LONGEST, np.uint64))
            for size, at, one, two, _ in _active(lang, h, spread.value, False, all_of=True):
                own = np.flatnonzero((one >> np.uint64(7)) % np.uint64(turns) == turn if turns else spread.value.has(1, one))
                at, one, two = at[own], one[own], two[own]
                words = [padded[at + i] if i < size else np.zeros(len(at), np.uint64) for i in range(LONGEST)]
                check = np.zeros(len(at), np.uint64)
                for w in words:
                    check = _mixed(check, w * ONE, ONE)
                name, first = np.unique(one ^ (check * TWO), return_index=True)
                if len(seen):
                    fresh = seen[np.minimum(np.searchsorted(seen, name), len(seen) - 1)] != name
                    name, first = name[fresh], first[fresh]
                seen = np.sort(np.concatenate([seen, name])) if len(seen) < REMEMBERED else name
                for s in range(0, len(first), 100_000):
                    own = first[s : s + 100_000]
                    columns = [x[own].view(np.int64) for x in (one, two, check, *words)]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), *map(pa.array, columns)], names=["lang", "k1", "k2", "check", *HASHED])

    kind = "lang string, k1 long, k2 long, check long, " + ", ".join(f"{x} long" for x in HASHED)
    return rows.select("lang", "words").mapInArrow(run, kind)


def identified(rows: DataFrame, found: DataFrame, bits: int) -> DataFrame | None:
    """k1, k2, f, lang, h1 to h5: the frequent phrases as sequences of words' hashes; None if there is no phrase.

    A phrase is looked for by one task in TURNS first; what those tasks do not hold is looked for by all."""
    spread = rows.sparkSession.sparkContext.broadcast
    done: DataFrame | None = None
    for turns in (TURNS, 0):
        keys = found.select("k1", "k2", F.lit(True).alias("new"))
        if done is not None:
            keys = found.join(done.select("k1", "k2", F.lit(False).alias("new")), ["k1", "k2"], "left").select("k1", F.coalesce("new", F.lit(True)).alias("new"))
        known = filters(keys, bits)
        if known is None:
            break
        known = spread(known)
        each = sequences(rows, known, turns).groupBy("k1", "k2", "lang").agg(F.min("check").alias("low"), F.max("check").alias("high"), *(F.first(x).alias(x) for x in HASHED))
        with setting(rows.sparkSession, *READ):
            more = stash(each.join(found, ["k1", "k2"]), "phrases-identified")
        known.destroy()
        # With a false hit in filter 1 a phrase comes a second time.
        done = more if done is None else done.unionByName(more.join(done.select("k1", "k2"), ["k1", "k2"], "left_anti"))
    if done is not None and not done.where("low <> high").isEmpty():
        raise HashClash("two phrases have one key")
    return None if done is None else done.drop("low", "high")


def _named(h: np.ndarray, other: np.ndarray) -> np.ndarray:
    return h ^ (other * TWO)


def spelled(docs: DataFrame, hashes: DataFrame, seed: int, bits: int) -> DataFrame:
    """h, word: the words with the hashes h.

    A word is looked for by one task in TURNS first. Then all tasks give what those did not hold: words not found so far, and
    words of a known hash whose second hash is another. A false hit of the filter of what is missing costs a row; one of the filter
    of what has been found could only hide such a clash, never a word."""

    def spread(keys: DataFrame, name: str) -> Broadcast | None:
        made = filters(keys.select(F.col(name).alias("k1"), F.lit(True).alias("new")), bits)
        return None if made is None else docs.sparkSession.sparkContext.broadcast(made)

    known = spread(hashes, "h")

    def words(turns: int, have: Broadcast | None, missing: Broadcast | None) -> DataFrame:
        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            turn = np.uint64(TaskContext.get().partitionId() % max(1, turns))
            seen = np.zeros(0, np.uint64)
            for b in batches(it, BATCH):
                w = Words(b, seed)
                own = np.flatnonzero((w.hash >> np.uint64(7)) % np.uint64(turns) == turn) if turns else np.arange(len(w.hash))
                own = own[known.value.has(0, w.hash[own])]
                other = word_hashes(w.low, w.start[own], w.end[own], seed + 1)
                name, first = np.unique(_named(w.hash[own], other), return_index=True)
                fresh = np.ones(len(name), bool) if have is None else ~have.value.has(0, name)
                if missing is not None:
                    fresh |= missing.value.has(0, w.hash[own[first]])
                if len(seen):
                    fresh &= seen[np.minimum(np.searchsorted(seen, name), len(seen) - 1)] != name
                name, first = name[fresh], first[fresh]
                seen = np.sort(np.concatenate([seen, name])) if len(seen) < REMEMBERED else name
                texts = [w.low[w.start[i] : w.end[i]].tobytes().replace(b"\xff", b"\x00").decode() for i in own[first].tolist()]
                columns = (pa.array(w.hash[own[first]].view(np.int64)), pa.array(name.view(np.int64)), pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(list(columns), names=["h", "name", "word"])

        return _texts(docs).mapInArrow(run, "h long, name long, word string").groupBy("h", "name").agg(F.first("word").alias("word"))

    first = stash(words(TURNS, None, None).join(hashes, "h"), "phrase-words")
    have, missing = spread(first, "name"), spread(hashes.join(first, "h", "left_anti"), "h")
    found = stash(first.unionByName(words(0, have, missing).join(hashes, "h")).groupBy("h", "name").agg(F.first("word").alias("word")), "phrase-words")
    for x in (known, have, missing):
        if x is not None:
            x.destroy()
    if not found.groupBy("h").count().where("count > 1").isEmpty():
        raise HashClash("two words have one hash")
    return found.select("h", "word")


def _keys(lang: str, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    one, two = (np.full(len(words[0]), x) for x in _begin(lang))
    zero = np.zeros(1, np.uint64)
    one, two = _mixed(one, zero, ONE) ^ words[0] * TWO, _mixed(two, zero, TWO) ^ words[0] * ONE
    for w in words[1:]:
        one, two = _mixed(one, w, ONE), _mixed(two, w, TWO)
    return one.view(np.int64), _key2(two, len(words)).view(np.int64)


def parts_of(phrases: DataFrame) -> DataFrame:
    """k1, k2, f, cut, right, p1, p2: the keys of the parts of each phrase (cut: the first and the rest; cut 0: all but the last word and all but the first)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            k1, k2, f, *h = (b.column(x).to_numpy(zero_copy_only=False) for x in ("k1", "k2", "f", *HASHED))
            kinds, lang = np.unique(np.array(b.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            for g, name in enumerate(kinds.tolist()):
                for size in range(2, LONGEST + 1):
                    own = np.flatnonzero((lang == g) & (k2 & 7 == size))
                    if not len(own):
                        continue
                    words = [x[own].view(np.uint64) for x in h[:size]]
                    cuts = [(cut, right, words[cut:] if right else words[:cut]) for cut in range(1, size) for right in (False, True)]
                    if size > 2:
                        cuts += [(0, False, words[:-1]), (0, True, words[1:])]
                    for cut, right, part in cuts:
                        p1, p2 = _keys(name, part)
                        columns = [k1[own], k2[own], f[own], np.full(len(own), cut, np.int32), np.full(len(own), right), p1, p2]
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["k1", "k2", "f", "cut", "right", "p1", "p2"])

    return phrases.select("k1", "k2", "f", "lang", *HASHED).mapInArrow(run, "k1 long, k2 long, f long, cut int, right boolean, p1 long, p2 long")


def collocations(docs: DataFrame, threshold: int = 100, most: int = 2000, closed_percent: int = 100, shards: int = SHARDS, bits: int = BITS, seeds: tuple[int, ...] = (0, 2)) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the phrases of two to five words whose words belong together most.

    a = f(phrase), l and r the counts of its two parts at the cut of least score, n all words of the language, score
    floor(1000 a n / (l r)). Phrases inside a longer one that is as frequent (closed_percent of a) are left out. Null
    languages are "und"; null and empty texts have no words; repeated rows count as often as they come; doc_id is not read.

    Should a word of a frequent phrase share its hash with another word, or a phrase its key with another phrase that is looked up with it,
    all is done again with the next seed, and if that fails as well it is an error. Of words all occurrences are compared, by a Bloom filter.
    """
    for seed in seeds:
        # Rows of tokens are large: batches of the usual size would take much memory outside the heap.
        with batch_bytes(docs.sparkSession, "4m"):
            rows = stash(tokens(docs, shards, seed), "phrase-tokens", "zstd", WRITTEN)
            found = frequent(rows, threshold, shards, bits)
            try:
                named = identified(rows, found, bits)
                if named is None:
                    return docs.sparkSession.createDataFrame([], RESULT)
                words = spelled(docs, named.where("k2 & 7 = 1").select(F.col("h1").alias("h")).distinct(), seed, bits)
                break
            except HashClash:
                if seed == seeds[-1]:
                    raise
    f = found.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("f").alias("part_f"))
    longer = named.where("k2 & 7 > 1")
    parts = stash(parts_of(longer).join(f, ["p1", "p2"]), "phrase-parts")
    # A longer phrase's inner ones.
    inner = parts.where("cut = 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.max("f").alias("longer"))
    kept = longer.join(inner, ["k1", "k2"], "left").where(f"longer is null or 100 * longer < {closed_percent} * f")
    sides = parts.where("cut > 0").groupBy("k1", "k2", "cut").agg(F.max(F.when(~F.col("right"), F.col("part_f"))).alias("l"), F.max(F.when(F.col("right"), F.col("part_f"))).alias("r"))
    total = rows.groupBy("lang").agg(F.sum("n").alias("n"))
    scored = kept.join(sides, ["k1", "k2"]).join(total, "lang").withColumn(
        "score", F.expr("(cast(1000 as decimal(38, 0)) * cast(f as decimal(20, 0)) * cast(n as decimal(20, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    )
    best = scored.groupBy("k1", "k2", "lang", F.col("f").alias("a"), "n", *HASHED).agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    best = best.select("k1", "k2", "lang", "a", "n", "best.*", F.posexplode(F.slice(F.array(*HASHED), 1, F.expr("cast(k2 & 7 as int)"))).alias("at", "h"))
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    named = best.join(words, "h").groupBy("k1", "k2", "lang", "a", "l", "r", "n", "score").agg(phrase.alias("phrase"))
    return top(named.select("lang", "phrase", "a", "l", "r", "n", "score"), most)


def top(scored: DataFrame, most: int) -> DataFrame:
    """The first rows of each language with their rank. The rows are sorted as a whole, over many tasks; a row's
    rank is its place in its task's part and the number of its language's rows in the parts before."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = scored.repartitionByRange(partitions_for(scored), F.col("lang"), *order)
    parts = stash(dealt.withColumn("part", F.spark_partition_id()), "phrases-ranked")
    sizes = parts.groupBy("lang", "part").agg(F.count("*").alias("rows"))
    before = sizes.withColumn("before", F.sum("rows").over(Window.partitionBy("lang").orderBy("part")) - F.col("rows")).where(F.col("before") < most).drop("rows")
    rank = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)) + F.col("before")
    ranked = parts.join(before, ["lang", "part"]).withColumn("rank", rank.cast("long"))
    return ranked.where(F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
