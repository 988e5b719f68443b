"""Helpers that the operators of this subpackage share.

Text arrives in Arrow batches; a batch is tokenised as one byte buffer with
numpy, so that a task never holds more than a batch and runs no loop per word.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts write it: [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, by spark.checkpoint.dir; where a session of one machine names none, as in tests, one of our own."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        app = spark.sparkContext.applicationId
        known = _own_dirs.setdefault(app, "") or "file://" + tempfile.mkdtemp(prefix="spark-newslode-")
        _own_dirs[app] = known
    return known.rstrip("/")


def stash(df: DataFrame, name: str, compression: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Cut the lineage: write df to the shared folder (options: of the Parquet writer) and read it again. What was shuffled for it goes as soon as it is written, not when the driver happens to collect its garbage."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.options(**options or {}).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(stashed: DataFrame) -> None:
    """Delete what stash wrote, once all that is made of it has been written."""
    spark = stashed.sparkSession
    for folder in {f.rpartition("/")[0] for f in stashed.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_rows(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text alone, so that no other column of the input can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def partitions_for(df: DataFrame, floor: int = 1) -> int:
    return max(floor, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def held_out(doc_id, modulus: int, remainder: int):
    """Contract's split: crc32 of the id as text, modulo a number."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus) == F.lit(remainder), F.lit(False))


def texts_of(column: pa.Array) -> list[str]:
    """Whole texts; null counts as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def byte_table(separators: bytes) -> np.ndarray:
    """Byte to lower-cased byte (A-Z alone), 0 for a separator. 0 itself must be a separator, or never occur."""
    to = np.arange(256, dtype=np.uint8)
    to[65:91] += 32
    to[np.frombuffer(separators, np.uint8)] = 0
    return to


def spans(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of non-zero bytes) of a buffer; no word crosses a row's edge."""
    if not len(low):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = low != 0
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets[:-1]] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64 bits for each word, eight bytes at a time; equal words have equal values in every batch."""
    size = end - start
    padded = np.concatenate([low, np.zeros(16, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    mask = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], np.uint64)
    mult, other = MIX if not seed else MIX[::-1]
    h = size.astype(np.uint64) * other + np.uint64(seed)
    at, todo = start, np.arange(len(start))
    left = size
    while len(todo):
        x = eight[at] & mask[np.minimum(left, 8)]
        y = (h[todo] ^ x) * mult
        y ^= y >> np.uint64(29)
        y *= other
        h[todo] = y ^ (y >> np.uint64(32))
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return h


def rows_of(start: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row in which each word stands."""
    return np.searchsorted(offsets, start, side="right") - 1


def hex_digest(data: bytes) -> str:
    import hashlib

    return hashlib.sha256(data).hexdigest()


def batches(it: Iterator[pa.RecordBatch], most: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """The batches, cut where the text in them passes a bound; a single longer text stays whole."""
    for b in it:
        size = b.get_total_buffer_size()
        parts = max(1, -(-size // most))
        rows = max(1, -(-b.num_rows // parts))
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's setting for what runs inside; its own comes back afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def batch_bytes(spark: SparkSession, most: str) -> AbstractContextManager[None]:
    """Arrow batches of no more than so many bytes for what runs inside."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", most)


def one_thread() -> None:
    """Numpy in a task uses the task's own core."""
    for k in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS"):
        os.environ.setdefault(k, "1")
