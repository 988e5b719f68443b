"""Prefix trie of conversations by ROLLUP.

A conversation is cut into blocks of eight turns. A block is one row: the node
the block hangs on (a digest of every turn before it) and eight columns of turn
ids. One ROLLUP over those columns aggregates the prefixes of all blocks of all
conversations at once; grouping_id tells how many turns a prefix takes of its
block. So no length is special: a long conversation only has more rows, each
keyed by the node its last block ended in.

A node is told by (smallest member, depth). Below the depth at which a
conversation first is the smallest member it stays so, and a conversation "owns"
this lower part of its path. What a node adds to the sums of its ancestors is
put on its owner, summed from the owner's end upwards, and a second ROLLUP adds
the owners up: the sums of all subtrees without a walk over levels.

Turns are told apart by 128 bits of SHA-256. A conversation passes through one
task turn by turn (24 bytes each, nothing is kept but the current block).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions_for, stash

WIDTH = 8
#: Ids of one chunk of a node's list of ends.
CHUNK_BITS = 12
ROOT = bytes(16)


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), id (of role and text), n_chars (code points of the text).

    Turns go by turn, null first; turns of the same number go by their id. Null role and text count as empty,
    repeated rows are turns of their own, rows without a conv_id are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)).alias("id"),
        F.length(text).cast("long").alias("n_chars"),
    )
    at = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    return turns.withColumn("pos", F.row_number().over(at)).drop("turn")


def rebuilt(turns: DataFrame, group: int = 100, modulus: int = 6) -> DataFrame:
    """conv_id, part, pos, id, n_chars: of each conversation first the first h turns of its group's first conversation
    (conv_id less its remainder by group), then its own turns after its first h, h = crc32(conv_id as text) % modulus;
    and a row with a null id, so that conversations left without turns are not lost. A conversation whose group has no such first keeps its own later turns alone."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus).cast("int")
    convs = turns.select("conv_id").distinct().select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("first_id"))
    opening = turns.where((F.col("conv_id") % group == 0) & (F.col("pos") < modulus)).withColumnRenamed("conv_id", "first_id")
    heads = convs.join(opening, "first_id").where("pos <= h").select("conv_id", F.lit(0).alias("part"), "pos", "id", "n_chars")
    tails = turns.where(F.col("pos") > h).select("conv_id", F.lit(1).alias("part"), "pos", "id", "n_chars")
    none = convs.select("conv_id", F.lit(2).alias("part"), F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("id"), F.lit(None).cast("long").alias("n_chars"))
    return heads.unionByName(tails).unionByName(none)


def _digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()[:16]


def _key(level: int) -> F.Column:
    """The node after so many turns of a block; after a whole block it is what the next block hangs on."""
    if not level:
        return F.col("base")
    return F.unhex(F.substring(F.sha2(F.concat("base", *(f"t{i}" for i in range(1, level + 1))), 256), 1, 32))


def blocks(turns: DataFrame) -> DataFrame:
    """Turns in order in; conv_id, block, base, t1.. and c1.. (ids and code points of the block's turns), ends (the node the conversation ends in, in its last block) out."""
    names = ["conv_id", "block", "base", *(f"t{i + 1}" for i in range(WIDTH)), *(f"c{i + 1}" for i in range(WIDTH)), "ends"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), *[pa.binary()] * WIDTH, *[pa.int64()] * WIDTH, pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now, block, base, ids, sizes = None, 0, ROOT, [], []

        def row(last: bool) -> tuple:
            gap = [None] * (WIDTH - len(ids))
            return (now, block, base, *ids, *gap, *sizes, *gap, (_digest(base, *ids) if ids else base) if last else None)

        for b in it:
            for conv, turn, size in zip(*(b.column(c).to_pylist() for c in ("conv_id", "id", "n_chars")), strict=True):
                if conv != now:
                    if now is not None:
                        out.append(row(True))
                    now, block, base, ids, sizes = conv, 0, ROOT, [], []
                if turn is None:
                    continue
                if len(ids) == WIDTH:
                    out.append(row(False))
                    block, base, ids, sizes = block + 1, _digest(base, *ids), [], []
                ids.append(turn)
                sizes.append(size)
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], schema=schema)
                out = []
        if now is not None:
            out.append(row(True))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], schema=schema)

    kind = ", ".join(f"{n} {'long' if k == pa.int64() else 'binary'}" for n, k in zip(names, kinds, strict=True))
    return turns.repartition(partitions_for(turns), "conv_id").sortWithinPartitions("conv_id", "part", "pos").select("conv_id", "id", "n_chars").mapInArrow(run, kind)


def _rollup(wide: DataFrame, values: str) -> DataFrame:
    """The prefixes of all blocks by one ROLLUP: block, base, t1.., level (turns taken of the block) and the values; of groups without a turn only the root is kept."""
    turns = ", ".join(f"t{i + 1}" for i in range(WIDTH))
    found = wide.sparkSession.sql(f"SELECT block, base, {turns}, {WIDTH} - CAST(bit_count(grouping_id()) AS INT) AS level, {values} FROM {{wide}} GROUP BY block, base, ROLLUP ({turns})", wide=wide)
    last = F.coalesce(*(F.when(F.col("level") == i, F.col(f"t{i}").isNotNull()) for i in range(1, WIDTH + 1)), F.col("block") == 0)
    return found.where(last).withColumn("depth", F.col("block") * WIDTH + F.col("level"))


def _at_level(*columns: F.Column) -> F.Column:
    """The column of the group's own level."""
    return F.coalesce(*(F.when(F.col("level") == i, c) for i, c in enumerate(columns)))


def ends_digest(wide: DataFrame) -> DataFrame:
    """key, ends_sha256: of each node in which conversations end, SHA-256 of their ids in ascending order, joined by commas.

    Ids are gathered by ranges of 4,096, then streamed range by range through the node's hash: of a node with
    a third of all conversations only text passes one task, no list of it is ever held.
    """
    chunks = (
        wide.where("ends is not null").groupBy(F.col("ends").alias("key"), F.shiftright("conv_id", CHUNK_BITS).alias("chunk"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    )

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h, keys, found = None, None, [], []
        for b in it:
            for key, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if key != now:
                    if h:
                        keys.append(now)
                        found.append(h.hexdigest())
                    now, h = key, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["key", "ends_sha256"])
            keys, found = [], []
        if h:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([h.hexdigest()])], names=["key", "ends_sha256"])

    return chunks.repartition(partitions_for(chunks), "key").sortWithinPartitions("key", "chunk").select("key", "ids").mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """A row for each distinct prefix of the conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: conv_id, part, pos (the order of a conversation's turns), id, n_chars; a row with a null id names a
    conversation, turnless or not. No conversation, no node.
    """
    wide = stash(blocks(turns), "trie-blocks")
    first = _rollup(wide, "min(conv_id) AS conv_id, count(*) AS n_convs, " + ", ".join(f"max(c{i}) AS c{i}" for i in range(1, WIDTH + 1)))
    nodes = stash(
        first.select(
            "conv_id", "depth", "n_convs",
            _at_level(*(_key(i) for i in range(WIDTH + 1))).alias("key"),
            _at_level(F.lit(None).cast("binary"), *(_key(i) for i in range(WIDTH))).alias("parent"),
            F.coalesce(_at_level(F.lit(0), *(F.col(f"c{i}") for i in range(1, WIDTH + 1))), F.lit(0)).alias("n_chars"),
        ),
        "trie-nodes",
    )
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = stash(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-counted")

    upward = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    owned = nodes.select(
        "conv_id", "depth", F.sum((F.col("n_convs") - 1) * F.col("n_chars")).over(upward).alias("saved"), F.sum((F.col("n_children") == 0).cast("long")).over(upward).alias("leaves"),
        F.floor((F.greatest("depth", F.lit(1)) - 1) / WIDTH).cast("long").alias("block"),
    ).withColumn("level", F.col("depth") - F.col("block") * WIDTH)
    whole = owned.groupBy("conv_id").agg(F.min_by("saved", "depth").alias("saved"), F.min_by("leaves", "depth").alias("leaves"))
    levels = range(WIDTH + 1)
    in_block = owned.groupBy("conv_id", "block").agg(*(F.max(F.when(F.col("level") == i, F.col(c))).alias(f"{c[0]}_{i}") for c in ("saved", "leaves") for i in levels))
    # Above its own part a conversation counts with all of it.
    valued = (
        wide.drop("ends").join(in_block, ["conv_id", "block"], "left").join(whole, "conv_id", "left")
        .withColumns({f"{c[0]}_{i}": F.coalesce(F.col(f"{c[0]}_{i}"), F.col(c), F.lit(0)) for c in ("saved", "leaves") for i in levels})
    )
    sums = _rollup(valued, "min(conv_id) AS conv_id, " + ", ".join(f"sum({c}_{i}) AS {c}_{i}" for c in "sl" for i in levels)).select(
        "conv_id", "depth", _at_level(*(F.col(f"s_{i}") for i in levels)).alias("saved_tokens"), _at_level(*(F.col(f"l_{i}") for i in levels)).alias("n_leaves")
    )
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(sums, ["conv_id", "depth"]).join(parents, "parent", "left").join(ends_digest(wide), "key", "left")
        .select(
            "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
