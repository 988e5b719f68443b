"""Models trained on bounded samples of labelled texts."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held: tuple[int, int], rows_per_class: int, most_chars: int) -> DataFrame:
    """doc_id, text, label of rows_per_class ids of each class at most, drawn by a hash of the id.

    Held-out rows, null labels, null ids and texts of over most_chars teach nothing. An id with both labels counts
    as labelled 1; of an id with several texts the smallest teaches. The sample holds 2 * rows_per_class * most_chars characters at most.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), *held)).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where(F.length("text") <= most_chars)
    return own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def trained(sample: DataFrame, train: Callable[[list[tuple[str, int]]], object]):
    """What train makes of (text, label) rows, in order of id. It runs in a task, so the driver holds no more than the model, and a lost executor
    costs no more than a new attempt."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in it for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "label")), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train([r[1:] for r in rows]))], pa.binary())], names=["model"])

    found = sample.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(found[0]) if found else train([])
