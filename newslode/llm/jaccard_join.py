"""N-gram Jaccard join by several global token orders.

A document is the set of its five-word shingles, each 64 bits. Sets at least t
alike share a token of their prefixes under every global order, so candidates
are those that pass under all of these:

A  ascending hashes. Each set gives its first r + l tokens, r being how many a
   partner may lack and l a third of that: partners share l of them (not one), which
   nearly all sets fail, since most of their tokens occur nowhere else.
B  rarest first, within what A took. Partners share l tokens there, so they share
   one of the first |A| - l + 1. Tokens of one set alone come first and meet nobody;
   tokens common everywhere come last and are seldom reached.
C  descending hashes, looked at on the candidate pair before it is verified.

Equal sets are one class. A token of few classes gives all its pairs. Of a token
of many, each class is paired with that token's leader first; what this links is one
component. Tokens whose classes are not all of one component by then are gone through in
square blocks of classes, sets and all, where only classes of different components
are compared. So a group of thousands of near copies is never written as pairs, and
no link between components is lost.

Whole sets travel only to pairs and blocks whose sketches pass first: a sketch has a bit for each remainder of
the tokens, set if an odd number of them has it. Sketches differ in no more bits than the sets differ in
tokens, so nothing is lost; halves of a sketch laid upon each other (XOR) are the sketch of half the bits.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, batches, buffer_of, byte_table, partitions_for, rows_of, spans, stash, text_rows, word_hashes
from .phrases import BITS, filters
from .simhash import components

#: A buffer's classes with a token from which on the token counts as heavy: last in order B, its rows dealt by class.
HEAVY = 32
#: Classes of a token up to which all their pairs are looked at; beyond, a leader and blocks.
SMALL, BLOCK = 32, 4096
#: Tokens of a block.
BLOCK_TOKENS = 1_000_000
LAST = 2**31 - 1


def allowed(n, percent: int):
    """How many of n tokens a partner may lack."""
    return n - -(-n * percent // 100)


def apart(m, n, percent: int, whole=np.floor):
    """In how many tokens partners of m and n tokens may differ: of m + n the shared ones, at least percent of the union, twice less."""
    return m + n + 2 * whole(-percent * (m + n) / (100 + percent))


def extra(n, percent: int):
    """l of order A for a set of n tokens."""
    return allowed(n, percent) // 3 + 1


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Of each row its distinct shingles, ascending; fewer words than size are one shingle, no words none."""
    table = byte_table(SPACE.encode())
    table[0] = 0xFF  # a NUL is part of a word; this byte is in no UTF-8
    data, offsets = buffer_of(column)
    low = table[data]
    start, end = spans(low, offsets)
    words = word_hashes(low, start, end)
    bounds = np.searchsorted(rows_of(start, offsets), np.arange(len(offsets)))
    mix = lambda x, w: ((x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)) ^ (w * np.uint64(0xC2B2AE3D27D4EB4F))
    whole = np.full(max(0, len(words) - size + 1), size, np.uint64)
    for i in range(size):
        whole = mix(whole, words[i : i + len(whole)])
    whole ^= whole >> np.uint64(29)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(whole[a : b - size + 1])
        elif b > a:
            x = np.full(1, b - a, np.uint64)
            for i in range(a, b):
                x = mix(x, words[i : i + 1])
            yield x ^ (x >> np.uint64(29))
        else:
            yield words[:0]


def described(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, row (hash of the text), n (size of the set), k1, k2 (128 bits of the set), prefix (order A; only of the first row of a set in a task)."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("prefix", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches(it):
            n, keys, prefixes = [], [], []
            for s in shingle_sets(b.column("text"), size):
                key = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                n.append(len(s))
                keys.append(key)
                prefixes.append(None if not len(s) or key in seen else s[: allowed(len(s), percent) + extra(len(s), percent)].tobytes())
                seen.add(key)
            if len(seen) > 500_000:
                seen.clear()
            k = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(n, pa.int64()), pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(prefixes, pa.binary())], schema=schema)

    return text_rows(docs).withColumn("row", F.xxhash64("text")).mapInArrow(run, "doc_id long, row long, n long, k1 long, k2 long, prefix binary")


def _tokens(many: int):
    """cid, n and prefix in; token, cid, n out. A token's lowest bit is set if many of this buffer have it, and then one row says so where it is clear (cid 0)."""

    def flush(cid: list, n: list, prefix: list) -> pa.RecordBatch:
        sizes = np.array([len(x) // 8 for x in prefix], np.int64)
        token = np.frombuffer(b"".join(prefix), np.uint64) & ~np.uint64(1)
        _, where, count = np.unique(token, return_inverse=True, return_counts=True)
        heavy = count[where] >= many
        marks = np.unique(token[heavy])
        none = np.zeros(len(marks), np.int64)
        token = np.concatenate([token | heavy.astype(np.uint64), marks]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(np.concatenate([np.repeat(np.array(cid, np.int64), sizes), none])), pa.array(np.concatenate([np.repeat(np.array(n, np.int64), sizes), none]))], names=["token", "cid", "n"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        size = 0
        for b in it:
            for row in zip(*(b.column(c).to_pylist() for c in ("cid", "n", "prefix")), strict=True):
                for to, x in zip(held, row, strict=True):
                    to.append(x)
                size += len(row[2]) // 8
                if size > 1_000_000:
                    yield flush(*held)
                    held, size = ([], [], []), 0
        if size:
            yield flush(*held)

    return run


def _shared(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _tokens sorted by token and cid in; cid, n, token, df out for tokens of two classes or more."""

    def groups(token: np.ndarray, cid: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        if len(token):
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (cid[1:] != cid[:-1])
            token, cid, n = token[new], cid[new], n[new]
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            marked = np.logical_or.reduceat(cid == 0, first) | (token[first] & 1 == 1)
            df = np.diff(np.append(first, len(token)))
            each = np.repeat(np.where(marked, LAST, df), df)
            keep = (each > 1) & (cid != 0)
            token, cid, n, df = token[keep] & ~np.int64(1), cid[keep], n[keep], each[keep]
        else:
            df = token
        return pa.RecordBatch.from_arrays([pa.array(cid), pa.array(n), pa.array(token), pa.array(df.astype(np.int64))], names=["cid", "n", "token", "df"])

    rest = tuple(np.zeros(0, np.int64) for _ in range(3))
    for b in it:
        now = tuple(np.concatenate([r, b.column(c).to_numpy(zero_copy_only=False)]) for r, c in zip(rest, ("token", "cid", "n"), strict=True))
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))
        yield groups(*(x[:cut] for x in now))
        rest = tuple(x[cut:] for x in now)
    yield groups(*rest)


def prefixes(described_rows: DataFrame, percent: int) -> DataFrame:
    """token, cid, n: what each class that passes A keeps under B."""
    n = partitions_for(described_rows)
    tokens = described_rows.where("prefix is not null").select(F.col("k1").alias("cid"), "n", "prefix").mapInArrow(_tokens(HEAVY), "token long, cid long, n long")
    # A heavy token's rows are dealt by class as well, so that no task gets them all.
    dealt = tokens.repartition(n, F.when(F.col("token").bitwiseAND(1) == 1, F.xxhash64("token", "cid")).otherwise(F.col("token"))).sortWithinPartitions("token", "cid")
    shared = dealt.mapInArrow(_shared, "cid long, n long, token long, df long").repartition(n, "cid").distinct()
    own = Window.partitionBy("cid")
    least = f"(n * {percent} + 99) div 100"  # the smallest partner
    need = F.expr(f"(({least}) - (({least}) * {percent} + 99) div 100) div 3 + 1")
    ranked = shared.withColumns({"shared": F.count("*").over(own), "rank": F.row_number().over(own.orderBy("df", "token"))})
    return ranked.where(F.col("rank") <= F.col("shared") - need + 1).select("token", "cid", "n")


NAMES = ["token", "i", "j", "own", "cid", "n", "cls", "label"]
HOPEFUL = ["token", "i", "j", "own", "cid", "label"]


def _comparable(x: dict, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of a block each row that is held against others, and those: of other components, and of a size that allows it. Labels are read anew for each."""
    other = x["own"] != x["i"] if x["i"][0] != x["j"][0] else np.ones(len(x["n"]), bool)
    for k in np.flatnonzero(x["own"] == x["i"]).tolist():
        near = other & (x["label"] != x["label"][k]) & (100 * np.minimum(x["n"], x["n"][k]) >= percent * np.maximum(x["n"], x["n"][k]))
        if near.any():
            yield k, near


def _in_blocks(percent: int, wanted: list[str], told):
    """Rows of NAMES and a list `tokens`, sorted by block, in; what told(x, lists, at, percent) says of each block out, as columns. lists: those of the block end to end, at: where each begins."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: dict[str, np.ndarray] = {c: np.zeros(0, np.int64) for c in NAMES}
        sets: list[np.ndarray] = []

        def done(upto: int) -> pa.RecordBatch:
            """What is said of the blocks that end before a row."""
            edge = np.flatnonzero(np.any([rest[c][1:upto] != rest[c][: upto - 1] for c in NAMES[:3]], axis=0)) + 1
            found = []
            for s, e in itertools.pairwise([0, *edge.tolist(), upto]):
                x = {c: v[s:e].copy() for c, v in rest.items()}
                if (x["label"] != x["label"][0]).any():
                    at = np.concatenate([[0], np.cumsum([len(y) for y in sets[s:e]])])
                    found += told(x, np.concatenate(sets[s:e]), at, percent)
            columns = zip(*found, strict=True) if found else [()] * len(wanted)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=wanted)

        for b in it:
            rest = {c: np.concatenate([rest[c], b.column(c).to_numpy(zero_copy_only=False)]) for c in NAMES}
            lists = b.column("tokens")
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            sets += [flat[s:e] for s, e in itertools.pairwise(at.tolist())]
            last = np.flatnonzero(np.any([rest[c] != rest[c][-1:] for c in NAMES[:3]], axis=0))
            if len(last):
                cut = int(last[-1]) + 1
                yield done(cut)
                rest, sets = {c: v[cut:] for c, v in rest.items()}, [x.copy() for x in sets[cut:]]
        if sets:
            yield done(len(sets))

    return run


def _hopeful(x: dict, sketches: np.ndarray, at: np.ndarray, percent: int) -> list[tuple]:
    """Rows that may have a partner of another component in their block, by the sketches; no more than came in."""
    n, width, may = x["n"], np.diff(at), np.zeros(len(x["n"]), bool)
    sketches = sketches.view(np.uint64)  # of signed numbers numpy counts the bits of the absolute value
    own = {w: np.flatnonzero(width == w) for w in np.unique(width).tolist()}
    table = {w: sketches[at[rows][:, None] + np.arange(w)] for w, rows in own.items()}
    half = {w: t[:, : w // 2] ^ t[:, w // 2 :] for w, t in table.items()}
    for k, near in _comparable(x, percent):
        w, mine = int(width[k]), sketches[at[k] : at[k + 1]]
        differ = np.zeros(len(n), np.int64)
        for v, one, others in ((w, mine, table), (2 * w, mine, half), (w // 2, mine[: w // 2] ^ mine[w // 2 :] if w > 1 else None, table)):
            if v in own and one is not None:
                differ[own[v]] = np.bitwise_count(others[v] ^ one).sum(1, dtype=np.int64)
        partners = near & (differ <= apart(n, n[k], percent))
        may |= partners
        may[k] |= partners.any()
    return list(zip(*(x[c][may].tolist() for c in HOPEFUL), strict=True))


def _links_across(x: dict, tokens: np.ndarray, at: np.ndarray, percent: int) -> list[tuple]:
    """Links between classes of different components of a block.

    A class is held against all others of its block at once, unless none is left in another component: what is
    linked already, here or before, is not compared again.
    """
    n, cls, label, found = x["n"], x["cls"], x["label"], []
    ids = np.unique(tokens, return_inverse=True)[1]
    flag = np.zeros(ids.max(initial=0) + 1, np.int64)
    for k, near in _comparable(x, percent):
        mine = ids[at[k] : at[k + 1]]
        flag[mine] = 1
        both = np.add.reduceat(flag[ids], at[:-1])
        flag[mine] = 0
        for y in np.flatnonzero(near & (100 * both >= percent * (n + n[k] - both))).tolist():
            if label[y] != label[k]:
                found.append((int(cls[k]), int(cls[y])))
                label[label == label[y]] = label[k]
    return found


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of cid in; a, b out: classes whose sets are alike enough. The sketches, then orders A and C are looked at before the sets are intersected."""
    one, two = (sets.select(F.col("cid").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}")) for s in "ab")
    many = F.least(F.size("sketch_a"), F.size("sketch_b"))

    def cut(c: str):
        """The sketch in as many numbers as the other has; sketches of more than twice as many are not folded, and tell nothing."""
        return F.when(F.size(c) == many, F.col(c)).otherwise(F.transform(F.slice(c, 1, many), lambda v, i: v.bitwiseXOR(F.get(c, i + many))))

    differ = F.aggregate(F.zip_with(cut("sketch_a"), cut("sketch_b"), lambda v, w: F.bit_count(v.bitwiseXOR(w))), F.lit(0), lambda v, w: v + w)
    alike = (F.greatest(F.size("sketch_a"), F.size("sketch_b")) > 2 * many) | (differ <= apart(F.col("n_a"), F.col("n_b"), percent, F.floor))
    pairs = pairs.join(two, "b").join(one, "a").where(alike).select("a", "b")
    one, two = (sets.select(F.col("cid").alias(s), F.col("cls").alias(f"cls_{s}"), F.col("n").alias(f"n_{s}"), F.col("tokens").alias(f"tokens_{s}")) for s in "ab")
    more = {s: F.expr(f"n_{s} - (n_{s} * {percent} + 99) div 100 + 1").cast("int") for s in "ab"}
    first = F.arrays_overlap(*(F.slice(f"tokens_{s}", 1, more[s]) for s in "ab"))
    last = F.arrays_overlap(*(F.slice(f"tokens_{s}", -more[s], more[s]) for s in "ab"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long")
    return pairs.join(two, "b").join(one, "a").where(first & last).where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b"))


def sketch(s: np.ndarray) -> np.ndarray:
    """A bit for each remainder of the tokens by a power of two, at least as large as the set, set if an odd number of tokens has it."""
    bits = max(64, 1 << (len(s) - 1).bit_length() if len(s) else 0)
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def small_set(s: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """What order A takes of a set, cut to 31 bits, and how many of it a partner shares at least."""
    first = s[: allowed(len(s), percent) + extra(len(s), percent)]
    low = np.unique(first & np.uint64(2**31 - 1)).astype(np.int32)
    return low, extra(len(s), percent) - (len(first) - len(low))


def token_sets(docs: DataFrame, wanted: DataFrame, size: int, percent: int) -> DataFrame:
    """cls, cid, n, tokens, sketch of the wanted rows (doc_id, row, cls, cid). A Bloom filter of these lets few other texts be shuffled."""
    schema = pa.schema([("cls", pa.int64()), ("cid", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])
    made = filters(wanted.select(F.xxhash64("doc_id", "row").alias("k1"), F.lit(True).alias("new")), BITS)
    known = None if made is None else docs.sparkSession.sparkContext.broadcast(made)

    def some(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found = known.value.has(0, b.column("k").to_numpy(zero_copy_only=False).view(np.uint64)) if known else np.zeros(b.num_rows, bool)
            yield b.drop_columns(["k"]).filter(pa.array(found))

    def lists(found: list[np.ndarray]) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.array(np.concatenate([*(x.view(np.int64) for x in found), np.zeros(0, np.int64)])))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches(it):
            new = [i for i, c in enumerate(b.column("cls").to_pylist()) if not (c in seen or seen.add(c))]
            b = b.take(pa.array(new, pa.int64()))
            found = list(shingle_sets(b.column("text"), size))
            columns = [pa.array([len(s) for s in found], pa.int64()), lists(found), lists([sketch(s) for s in found])]
            yield pa.RecordBatch.from_arrays([b.column("cls"), b.column("cid"), *columns], schema=schema)

    row = F.xxhash64("text")
    texts = text_rows(docs).withColumn("row", row).withColumn("k", F.xxhash64("doc_id", "row")).mapInArrow(some, "doc_id long, text string, row long")
    w = wanted.select(F.col("doc_id").alias("d"), F.col("row").alias("r"), "cls", "cid")
    return texts.join(w, texts.doc_id.eqNullSafe(w.d) & (texts.row == w.r)).select("cls", "cid", "text").mapInArrow(run, "cls long, cid long, n long, tokens array<long>, sketch array<long>")


def links_of(docs: DataFrame, rows: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) of classes: those of each component hold it together, and none is missing between two components."""
    prefix = stash(prefixes(rows, percent), "jaccard-prefixes")
    # Each token has a leader of its own, so a class of a large group is paired with many of the others.
    buckets = prefix.groupBy("token").agg(F.count("*").alias("many"), F.sum("n").alias("all_tokens"), F.min_by(F.struct("cid", "n"), F.xxhash64("token", "cid")).alias("leader")).where("many > 1")
    in_bucket = stash(prefix.join(buckets, "token"), "jaccard-buckets")
    wanted = classes.join(in_bucket.select(F.col("cid").alias("k1")).distinct(), "k1", "left_semi").withColumnRenamed("k1", "cid")
    sets = stash(token_sets(docs, wanted, size, percent), "jaccard-sets")

    near = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    small = in_bucket.where(F.col("many") <= SMALL)
    one, two = (small.select("token", F.col("cid").alias(s), F.col("n").alias(f"n{s}")) for s in "ab")
    few = one.join(two, "token").where((F.col("a") < F.col("b")) & near).select("a", "b")
    large = in_bucket.where(F.col("many") > SMALL)
    star = large.select("cid", "n", F.col("leader.cid").alias("l"), F.col("n").alias("na"), F.col("leader.n").alias("nb")).where((F.col("cid") != F.col("l")) & near).select(F.least("cid", "l").alias("a"), F.greatest("cid", "l").alias("b"))
    links = stash(verified(few.unionByName(star).distinct(), sets, percent), "jaccard-links")

    if large.isEmpty():
        return links
    rooted = sets.select("cls", "cid").join(components(links).withColumnRenamed("node", "cls"), "cls", "left").select("cid", F.coalesce("root", "cls").alias("label"))
    # A row for each class, with its tokens: labels need not be joined to every token of it.
    labelled = stash(large.groupBy("cid", "n").agg(F.collect_list("token").alias("tokens")).join(rooted, "cid"), "jaccard-labelled")
    each = labelled.select("cid", "n", "label", F.explode("tokens").alias("token"))
    # Of tokens that the same classes have, as those of one passage, one is enough.
    same = {"x": F.bit_xor(F.xxhash64("cid")), "y": F.bit_xor(F.xxhash64("cid", F.lit(1))), "many": F.count("*"), "all_tokens": F.sum("n")}
    split = each.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), *(v.alias(k) for k, v in same.items())).where("low <> high").groupBy(*same).agg(F.min("token").alias("token"))
    blocks = F.ceil(F.greatest(F.col("many") / BLOCK, F.col("all_tokens") / BLOCK_TOKENS)).cast("long")
    dealt = (
        each.drop("n").join(split.select("token", blocks.alias("blocks")), "token").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "label")
    )

    def compared(rows: DataFrame, tokens: str, wanted: list[str], told) -> DataFrame:
        rows = rows.join(sets.select("cid", "n", "cls", F.col(tokens).alias("tokens")), "cid").select(*NAMES, "tokens")
        parts = rows.repartition(partitions_for(rows), "token", "i", "j").sortWithinPartitions("token", "i", "j")
        return parts.mapInArrow(_in_blocks(percent, wanted, told), ", ".join(f"{c} long" for c in wanted))

    hopeful = compared(dealt, "sketch", HOPEFUL, _hopeful)
    return links.unionByName(compared(hopeful, "tokens", ["a", "b"], _links_across))


def near_sets(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), a row for each row of docs.

    Null and empty texts, and texts without words, have no shingles and link with nothing; fewer words than size are
    one shingle. Repeated rows return as often as they come. Rows with a null id join a component but never name it
    unless nothing else does. Shingles are told apart by 64 bits, classes by 128.
    """
    rows = stash(described(docs, size, percent), "jaccard-rows")
    classes = rows.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "row")).alias("rep"))
    classes = stash(classes.select("k1", "k2", "least", "rep.*", F.monotonically_increasing_id().alias("cls")), "jaccard-classes")
    found = components(links_of(docs, rows.select("k1", "n", "prefix"), classes, size, percent))
    rooted = classes.join(found, classes.cls == found.node, "left").select("k1", "k2", "least", F.coalesce("root", "cls").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    final = rooted.join(named, "root").select("k1", "k2", "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rows.where("n > 0").join(final, ["k1", "k2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)
