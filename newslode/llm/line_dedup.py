"""Line dedup.

Each long line becomes a 128-bit hash. The rows (hash, document, positions)
are range-partitioned by hash, document and text, sorted with the largest
document first, and streamed: the first document of a hash keeps its lines, the
others lose theirs if enough documents share the hash. The range key includes
the document, so a line that stands in a third of all documents is spread over
many partitions; what a partition can't decide about the hash at its edges is
settled from one small summary row per partition edge. The result is a
compressed bitmap of dropped lines per document, never text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, hex_digest, partitions_for, stash, text_rows, texts_of

LINES = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("row", pa.int64()), ("at", pa.list_(pa.int32()))])
PARTS = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("row", pa.int64()), ("at", pa.list_(pa.int32())), ("kind", pa.int32()), ("n", pa.int64())])
DROP, OPEN, SUMMARY = 0, 1, 2
#: Names that no input column has.
ROW, KEY, KEY_ROW, DROPS = (f"__newslode_{n}" for n in ("row", "key", "key_row", "drops"))


def line_key(line: str) -> str:
    """White space stripped at both ends, A-Z lower-cased."""
    line = line.strip(SPACE)
    return line.lower() if line.isascii() else line.encode().lower().decode()


def emit_lines(min_chars: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids, rows = b.column("doc_id").to_pylist(), b.column("row").to_pylist()
            out: tuple[list, list, list, list] = ([], [], [], [])
            for doc, row, text in zip(ids, rows, texts_of(b.column("text")), strict=True):
                if doc is None:  # without an id a row belongs to no document: it keeps its lines and counts for none
                    continue
                at: dict[bytes, list[int]] = {}
                for i, line in enumerate(text.split("\n")):
                    if len(line) >= min_chars and len(line := line.strip(SPACE)) >= min_chars:
                        at.setdefault(xxhash.xxh3_128_digest(line.encode().lower()), []).append(i)
                for k, v in at.items():
                    for col, x in zip(out, (k, doc, row, v), strict=True):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, LINES, strict=True)], schema=LINES)

    return run


def stream_groups(min_docs: int):
    """Sorted rows of one partition in; out: positions to drop, rows that another partition must help decide, and edge summaries."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        group: list[tuple] = []  # rows not decided yet: until min_docs documents have come
        key, first_key = None, True
        docs, last, top = 0, None, None

        def close(end: bool) -> None:
            nonlocal group, first_key
            if key is not None and (first_key or end):
                out.extend((*r, OPEN, 0) for r in group)
                out.append((key, top, None, None, SUMMARY, docs))
            group = []
            first_key = first_key and key is None

        for b in it:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[0] != key:
                    close(False)
                    key, docs, last, top = r[0], 0, None, r[1]
                if r[1] != last:
                    docs, last = docs + 1, r[1]
                if first_key:  # the hash may have begun in the partition before
                    out.append((*r, OPEN, 0))
                elif docs < min_docs:
                    group.append(r)
                else:
                    out.extend((*x, DROP, 0) for x in group if x[1] != top)
                    if r[1] != top:
                        out.append((*r, DROP, 0))
                    group = [x for x in group if x[1] == top]  # these stay, whatever the next partition holds
                    if docs == min_docs:
                        group = []
            if len(out) >= 20_000:
                yield packed(out)
                out.clear()
        close(True)
        if out:
            yield packed(out)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PARTS, strict=True)], schema=PARTS)

    return run


def bitmap(at: np.ndarray) -> bytes:
    """Dropped positions as a compressed bitmap, lowest line in the lowest bit."""
    bits = np.zeros(int(at.max()) + 1, np.uint8)
    bits[at] = 1
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)


def positions(packed: bytes | None) -> set[int]:
    if not packed:
        return set()
    return set(np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), bitorder="little")).tolist())


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, row (hash of the text), drops (compressed bitmap of lost lines), for the documents that lose any.

    Null and empty texts have one empty line and lose nothing; a repeated row
    counts as one document; a null doc_id takes no part.
    """
    rows = text_rows(docs).withColumn("row", F.xxhash64("text"))
    # Written once: finding the ranges reads the lines a first time, dealing them out a second.
    lines = stash(rows.mapInArrow(emit_lines(min_chars), "key binary, doc_id long, row long, at array<int>"), "lines")
    order = [F.col("key"), F.col("doc_id").desc()]
    parts = stash(
        lines.repartitionByRange(partitions_for(lines), *order).sortWithinPartitions(*order, "row").mapInArrow(stream_groups(min_docs), "key binary, doc_id long, row long, at array<int>, kind int, n long"),
        "line-parts",
    )
    # At most two hashes of a partition are open, so this table has two rows per partition.
    edges = parts.where(F.col("kind") == SUMMARY).groupBy("key").agg(F.sum("n").alias("docs"), F.max("doc_id").alias("keeper")).where(F.col("docs") >= min_docs)
    open_rows = parts.where(F.col("kind") == OPEN).select("key", "doc_id", "row", "at").join(F.broadcast(edges), "key").where(F.col("doc_id") != F.col("keeper"))
    drops = parts.where(F.col("kind") == DROP).select("doc_id", "row", "at").unionByName(open_rows.select("doc_id", "row", "at"))

    @F.pandas_udf("binary")
    def as_bitmap(at):
        return at.map(lambda x: bitmap(np.concatenate(list(x))))

    return drops.groupBy("doc_id", "row").agg(F.collect_list("at").alias("at")).select("doc_id", "row", as_bitmap("at").alias("drops"))


def with_drops(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The rows of docs with the column DROPS (null: none)."""
    own = docs.withColumn(ROW, F.xxhash64(F.col("text").cast("string")))
    # Always a merge join: the drops grow with the documents, and the plan shall not change with the size.
    found = dropped_lines(docs, min_chars, min_docs).select(F.col("doc_id").alias(KEY), F.col("row").alias(KEY_ROW), F.col("drops").alias(DROPS)).hint("merge")
    return own.join(found, (F.col("doc_id") == F.col(KEY)) & (F.col(ROW) == F.col(KEY_ROW)), "left").drop(KEY, KEY_ROW, ROW)


def kept_text(text: str | None, drops: bytes | None) -> tuple[str | None, int, int]:
    """Text without the lost lines, lines before, lines lost."""
    lines = (text or "").split("\n")
    if not drops:
        return text, len(lines), 0
    lost = positions(drops)
    return "\n".join(x for i, x in enumerate(lines) if i not in lost), len(lines), len(lost)


def report(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 and drops, the bitmap itself."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string()), ("drops", pa.binary())])

    def digest(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            drops = b.column("drops").to_pylist()
            found = [kept_text(t, d) for t, d in zip(texts_of(b.column("text")), drops, strict=True)]
            cols = [b.column("doc_id").to_pylist(), [x[1] for x in found], [x[2] for x in found], [hex_digest(x[0].encode()) for x in found], drops]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return with_drops(text_rows(docs), min_chars, min_docs).select("doc_id", "text", F.col(DROPS).alias("drops")).mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string, drops binary")


def dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """docs with the lost lines taken out of text (n_chars follows where the table has it); other columns and all rows stay."""
    names = docs.columns

    @F.pandas_udf("string")
    def cut(text, drops):
        return text.combine(drops, lambda t, d: kept_text(t, d)[0])

    out = with_drops(docs, min_chars, min_docs)
    out = out.withColumn("text", F.when(F.col(DROPS).isNull(), F.col("text")).otherwise(cut("text", DROPS)))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col(DROPS).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*names)
