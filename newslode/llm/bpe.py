"""Byte-level BPE encoding and decoding.

A word's merges are a fold of Spark's higher-order functions over its byte array. The state is one
array of longs, a long for each piece: the rank of the pair that begins there, above the place
of the piece in the word, above the piece itself. The least long is the leftmost pair of lowest
rank; a step joins it and looks up the two pairs beside it. Ranks are read from a literal map
of pairs of pieces, kept as a table in which each left piece has a row, the rows pushed into each
other's gaps; an entry names the row it belongs to, so no pair is taken for another.
Only distinct words are folded: first the most frequent words of a sample, FREQUENT at
most, which every task then knows; of all other words, those of each chunk of documents,
in the chunk's own row. No shuffle is needed and any words give the same ids.
Decoding looks each id's bytes up and concatenates them.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, hex_digest, stash, text_rows, texts_of
from .pretokens import words_of

#: Words that every task knows, and documents (about) in which they are counted. They change the cost, never the result.
FREQUENT, COUNT_DOCS = 262_144, 30_000
#: Characters of a chunk; a longer text is a chunk of its own.
CHUNK_CHARS = 1_000_000
#: Bytes of a word beyond which the fold, whose cost grows with their square, gives way to a heap.
LONG_WORD = 1_000
#: Bits of a piece, and of its place, in a long of the state.
PIECE, PLACE = 20, 12
NO_PAIR = 1 << PIECE


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines())}


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """slots and rows: the rank of the pair of pieces a, b stands in slots[rows[a] + b], below a itself. Pieces count from 2 here, 1 is a word's edge and 0 an empty slot.

    Rows are laid from the longest to the shortest at the first fitting of some random places.
    """
    if max(ranks.values(), default=0) + 2 >= NO_PAIR:
        raise ValueError("too many pieces")
    pairs: dict[int, list[tuple[int, int]]] = {}
    for piece, rank in ranks.items():
        for k in range(1, len(piece)):
            a, b = ranks.get(piece[:k]), ranks.get(piece[k:])
            if a is not None and b is not None:
                pairs.setdefault(a + 2, []).append((b + 2, rank))
    width = max(ranks.values(), default=-1) + 3
    size = 1 << max(10, 2 + (sum(map(len, pairs.values()))).bit_length())
    slots, rows, g = np.zeros(size + width, np.int64), np.zeros(width, np.int64), np.random.default_rng(1)
    for a in sorted(pairs, key=lambda a: (-len(pairs[a]), a)):
        b, rank = np.array(pairs[a], np.int64).T
        while True:
            at = g.integers(0, size, 64 if len(b) < 10 else 2048)
            for part in (b[:6], b[6:]):
                if len(at) and len(part):
                    at = at[~slots[at[:, None] + part].any(1)]
            if len(at):
                break
        rows[a] = at[0]
        slots[at[0] + b] = a << PIECE | rank
    return slots, rows


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks of pairs, and the piece of each byte, as a literal."""
    slots, rows = pair_table(ranks)
    data = {"slots": slots.tolist(), "rows": rows.tolist(), "first": [ranks[bytes([x])] + 2 for x in range(256)]}
    return F.from_json(F.lit(json.dumps(data, separators=(",", ":"))), "struct<slots:array<bigint>,rows:array<int>,first:array<bigint>>")


def not_merged(ranks: dict[bytes, int]) -> dict[str, list[int]]:
    """Pieces that are words and that their own merges do not lead to; as words they have their own id. Trained vocabularies have none."""
    alone = {p: r for p, r in ranks.items() if len(p) > 1 and merge_long(p, ranks) != [r]}
    return {w: [r] for p, r in alone.items() if (w := p.decode(errors="ignore")).encode() == p}


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def long(n: int) -> Column:
    return F.lit(n).cast("long")


def encode_bytes(word: Column, ranks: Column) -> Column:
    """array<int> of the ids to which the bytes of a word (array<tinyint>) merge."""

    def fold(slots: Column, rows: Column, first: Column) -> Column:
        piece = lambda x: x.bitwiseAND(long(NO_PAIR - 1))
        # An entry of another row leaves bits above a rank's.
        rank = lambda a, b: F.least(F.get(slots, F.get(rows, a) + b).bitwiseXOR(F.shiftleft(a, PIECE)), long(NO_PAIR))
        ranked = lambda a, b: F.shiftleft(rank(a, b), PIECE + PLACE)
        edge = F.array(long(1))
        pieces = F.flatten(F.array(edge, F.transform(word, lambda x: F.get(first, x.cast("int").bitwiseAND(F.lit(255)))), edge))

        def start(p: Column) -> Column:
            return F.transform(p, lambda x, i: ranked(x, F.coalesce(F.get(p, i + 1), long(1))).bitwiseOR(F.shiftleft(i.cast("long"), PIECE)).bitwiseOR(x))

        def join(state: Column, low: Column, i: Column) -> Column:
            """The i-th piece (from 1) and the next become one: it and the piece before begin new pairs."""
            before, after = F.get(state, i - 2), F.get(state, i + 1)
            made = F.shiftright(low, PIECE + PLACE) + 2
            left = ranked(piece(before), made).bitwiseOR(before.bitwiseAND(long((1 << PIECE + PLACE) - 1)))
            own = ranked(made, piece(after)).bitwiseOR(low.bitwiseAND(long((1 << PIECE + PLACE) - NO_PAIR))).bitwiseOR(made)
            # Removing and inserting cost Spark less than slices. All longs of a state differ, by their places.
            rest = F.array_remove(F.array_remove(F.array_remove(state, low), F.get(state, i)), before)
            return F.array_insert(F.array_insert(rest, i - 1, own), i - 1, left)

        def step(state: Column, _: Column) -> Column:
            return let(F.array_min(state), lambda low: F.when(low >= long(NO_PAIR << PIECE + PLACE), state).otherwise(let(F.array_position(state, low).cast("int"), lambda i: join(state, low, i))))

        def ids(state: Column) -> Column:
            return F.transform(F.slice(state, F.lit(2), F.size(state) - 2), lambda x: (piece(x) - 2).cast("int"))

        return let(pieces, lambda p: F.aggregate(F.sequence(F.lit(1), F.size(p) - 3), start(p), step, ids))

    return let(ranks["slots"], lambda slots: let(ranks["rows"], lambda rows: fold(slots, rows, ranks["first"])))


def encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word too long for the fold."""
    return [ranks[word]] if word in ranks else merge_long(word, ranks)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges by a heap and links."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        alive[end[i]] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def frequent_words(docs: DataFrame, pattern: str, literal: Column, most: int, count_docs: int) -> pa.Table:
    """word, ids: the most frequent words of a sample of documents, folded by Spark; `most` rows at most reach the driver, in Arrow's few MB."""
    total = docs.count()
    sample = text_rows(docs).where((F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)) * F.lit(total) < count_docs)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        words, c = words_of(pattern), Counter()
        for b in it:
            for text in texts_of(b.column("text")):
                c.update(words(text))
            if len(c) > 200_000:
                yield pa.RecordBatch.from_pydict({"word": pa.array(c.keys(), pa.string()), "n": pa.array(c.values(), pa.int64())})
                c.clear()
        yield pa.RecordBatch.from_pydict({"word": pa.array(c.keys(), pa.string()), "n": pa.array(c.values(), pa.int64())})

    def spell(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            words = b.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("word"), byte_lists([w.encode() for w in words])], names=["word", "spelt"])

    words = sample.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.octet_length("word") <= 64)
    top = words.orderBy(F.col("n").desc(), "word").limit(most).repartition(max(8, docs.sparkSession.sparkContext.defaultParallelism), "word")
    return top.select("word").mapInArrow(spell, "word string, spelt array<tinyint>").select("word", let(literal, lambda ranks: encode_bytes(F.col("spelt"), ranks)).alias("ids")).toArrow()


def byte_lists(words: list[bytes]) -> pa.ListArray:
    """The byte arrays of words."""
    ends = np.cumsum([0, *map(len, words)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(words), np.int8)))


def end_to_end(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some words, and how many each has."""
    return np.array([i for x in lists for i in x], np.int32), np.array([len(x) for x in lists], np.int64)


def gather(codes: np.ndarray, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ids of a sequence of words, given all words' ids end to end."""
    start = (np.cumsum(size) - size)[codes]
    many = size[codes]
    at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start, many)
    return flat[at]


ENCODED = "doc_id long, ids array<int>"


def encode(spark: SparkSession, docs: DataFrame, path: str, pattern: str, frequent: int = FREQUENT, count_docs: int = COUNT_DOCS) -> DataFrame:
    """doc_id, ids (array<int>) for each row of docs.

    Null and empty texts have no ids; a vocabulary holds every single byte, so any text
    has ids; repeated rows each return; a null doc_id stays null.
    """
    folded, assemble = chunks(spark, docs, path, pattern, frequent, count_docs)
    return folded.mapInArrow(assemble, ENCODED)


def chunks(spark: SparkSession, docs: DataFrame, path: str, pattern: str, frequent: int = FREQUENT, count_docs: int = COUNT_DOCS, apart: bool = False):
    """Chunks of documents with the ids of their rare words, and the function that makes of their batches those of ENCODED.

    apart: chunks are written before they are folded, so that a task has one Python worker and not two; executors keep all workers they had."""
    ranks = load_ranks(path)
    literal = rank_map(ranks)
    words = frequent_words(docs, pattern, literal, frequent, count_docs)
    # Two broadcasts, each for one kind of task: a worker holds no more than it needs.
    odd = not_merged(ranks)
    lists = words.column("ids").combine_chunks()
    own_flat, own_size = end_to_end(list(odd.values()))
    # The words go out as an Arrow column; each task makes its table of numbers of them, the driver none.
    numbers = spark.sparkContext.broadcast((list(odd), words.column("word").combine_chunks()))
    known_ids = spark.sparkContext.broadcast((np.concatenate([own_flat, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)]), np.concatenate([own_size, np.diff(lists.offsets.to_numpy()).astype(np.int64)])))
    del words, lists
    table = spark.sparkContext.broadcast(ranks)

    def split(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = words_of(pattern), {}
        special, frequent_ones = numbers.value
        for i, w in enumerate([*special, *frequent_ones.to_pylist()]):
            number.setdefault(w, i)  # a frequent word that has an id of its own keeps that
        base = len(special) + len(frequent_ones)

        def chunk(ids: list, sizes: list, codes: list, rare: dict) -> pa.RecordBatch:
            spelt = pa.ListArray.from_arrays(pa.array([0, len(rare)], pa.int32()), byte_lists([w.encode() for w in rare]))
            return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([np.array(sizes, np.int64).tobytes()]), pa.array([np.concatenate([np.zeros(0, np.int32), *codes]).astype(np.int32).tobytes()]), spelt], names=["docs", "sizes", "codes", "rare"])

        ids, sizes, codes, rare, chars = [], [], [], {}, 0
        for b in batches(it, 4_000_000):
            for doc, text in zip(b.column("doc_id").to_pylist(), texts_of(b.column("text")), strict=True):
                if ids and chars + len(text) > CHUNK_CHARS:
                    yield chunk(ids, sizes, codes, rare)
                    ids, sizes, codes, rare, chars = [], [], [], {}, 0
                found = words(text)
                own = list(map(number.get, found))
                if None in own:
                    for i, c in enumerate(own):
                        if c is None:
                            own[i] = base + rare.setdefault(found[i], len(rare))
                ids.append(doc)
                sizes.append(len(own))
                codes.append(np.array(own, np.int32))
                chars += len(text)
        if ids:
            yield chunk(ids, sizes, codes, rare)

    def assemble(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_flat, known_size = known_ids.value
        for b in it:
            for n in range(b.num_rows):  # a chunk at a time, so that no more than one is unpacked
                doc, sizes, codes = (b.column(c)[n].as_py() for c in ("docs", "sizes", "codes"))
                found = b.column("found")[n].values
                if found.null_count:
                    spelt = b.column("rare")[n].values
                    own_flat, own_size = end_to_end([x if x is not None else encode_long(spelt[i].values.to_numpy().tobytes(), table.value) for i, x in enumerate(found.to_pylist())])
                else:
                    own_flat, own_size = found.flatten().to_numpy(zero_copy_only=False).astype(np.int32), np.diff(found.offsets.to_numpy()).astype(np.int64)
                size, flat = np.concatenate([known_size, own_size]), np.concatenate([known_flat, own_flat])
                word = np.frombuffer(codes, np.int32)
                doc_of = np.repeat(np.arange(len(doc)), np.frombuffer(sizes, np.int64))
                many = np.bincount(doc_of, weights=size[word], minlength=len(doc)).astype(np.int64)
                edges = np.concatenate([np.zeros(1, np.int64), np.cumsum(many)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.ListArray.from_arrays(pa.array(edges), pa.array(gather(word, flat, size)))], names=["doc_id", "ids"])

    chunks = text_rows(docs).mapInArrow(split, "docs array<long>, sizes binary, codes binary, rare array<array<tinyint>>")
    if apart:
        chunks = stash(chunks, "chunks", "zstd")
    # The literal is bound once: a plan that repeats it is slow to optimise and to print.
    folded = chunks.withColumn("found", let(literal, lambda ranks: F.transform("rare", lambda w: F.when(F.size(w) <= LONG_WORD, encode_bytes(w, ranks)))))
    return folded, assemble


def pieces_of(path: str) -> list[bytes]:
    ranks = load_ranks(path)
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        out[rank] = piece
    return out


def decoded_rows(b: pa.RecordBatch, ids: int, table: list[bytes]) -> Iterator[tuple[list[int], bytes]]:
    """ids and bytes of each row, unpacked row by row."""
    lists = b.column(ids)
    flat, valid = lists.flatten().to_numpy(zero_copy_only=False), lists.is_valid().to_numpy(zero_copy_only=False)
    many = np.where(valid, np.diff(lists.offsets.to_numpy()), 0)
    end = np.cumsum(many)
    for a, z in zip((end - many).tolist(), end.tolist()):
        own = flat[a:z].tolist()
        yield own, b"".join(map(table.__getitem__, own))


def decode(spark: SparkSession, encoded: DataFrame, path: str) -> DataFrame:
    """encoded and a column decoded (binary): the pieces of ids, concatenated. Null ids give empty bytes."""
    pieces = spark.sparkContext.broadcast(pieces_of(path))
    columns = encoded.columns
    schema = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes) + ", decoded binary"

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found = [data for _, data in decoded_rows(b, columns.index("ids"), pieces.value)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.binary())], names=[*columns, "decoded"])

    return encoded.mapInArrow(run, schema)


ROUND_TRIP = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def round_trip(spark: SparkSession, docs: DataFrame, path: str, pattern: str, with_ids: bool = False, apart: bool = False) -> DataFrame:
    """Encode and decode every row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if they are asked for. apart: as in chunks().

    A null or empty text has no tokens and decodes to no bytes; repeated rows each return; a null doc_id stays null.
    """
    pieces = spark.sparkContext.broadcast(pieces_of(path))
    folded, assemble = chunks(spark, docs, path, pattern, apart=apart)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = [str(i) for i in range(len(pieces.value))].__getitem__
        for b in assemble(it):  # in the same worker: ids need not pass through Spark to be decoded
            found = [(len(ids), hex_digest(",".join(map(shown, ids)).encode()), hex_digest(data)) for ids, data in decoded_rows(b, 1, pieces.value)]
            cols = [pa.array([x[i] for x in found], f.type) for i, f in enumerate(list(ROUND_TRIP)[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, *([b.column(1)] if with_ids else [])], names=[*ROUND_TRIP.names, *(["ids"] if with_ids else [])])

    return folded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else ""))
