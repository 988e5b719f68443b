"""Token counts by heap-and-linked-list byte-pair merging.

Every distinct word of a batch is merged once: a heap holds the ranks of the
adjacent pairs, links lead to the neighbours, and the lowest rank is popped until none is left. The
count is the initial symbols minus the merges; ids are never made.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import text_rows, texts_of

#: Words whose count a task remembers; the table of them is emptied when it is full.
REMEMBERED = 400_000
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def printable_bytes() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to, extra = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in to:
            to[b] = chr(256 + extra)
            extra += 1
    return [to[b] for b in range(256)]


def load_merges(path: str) -> tuple[dict[int, tuple[int, int]], list[int], list[str]]:
    """Pair of symbols (as one number) to its rank and product, the symbol of each byte, and special strings, from a tokenizer.json."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    merges: dict[int, tuple[int, int]] = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges[vocab[a] << 20 | vocab[b]] = (rank, vocab[a + b])
    return merges, [vocab[c] for c in printable_bytes()], [x["content"] for x in spec.get("added_tokens", [])]


def count_word(word: bytes, merges: dict[int, tuple[int, int]], symbol: list[int]) -> int:
    """Tokens of one word."""
    n = len(word)
    if n == 1:
        return 1
    sym = [symbol[b] for b in word]
    heap = []
    for i in range(n - 1):
        m = merges.get(sym[i] << 20 | sym[i + 1])
        if m:
            heap.append((m[0], i, sym[i], sym[i + 1], m[1]))
    if not heap:
        return n
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    count = n
    while heap:
        _, i, a, b, made = heapq.heappop(heap)
        j = after[i]
        if sym[i] != a or j >= n or sym[j] != b:
            continue  # one of the two was merged meanwhile
        sym[i], sym[j] = made, -1
        count -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            m = merges.get(made << 20 | sym[k])
            if m:
                heapq.heappush(heap, (m[0], i, made, sym[k], m[1]))
        p = before[i]
        if p >= 0:
            m = merges.get(sym[p] << 20 | made)
            if m:
                heapq.heappush(heap, (m[0], p, sym[p], made, m[1]))
    return count


def counter(rules: tuple, pattern: str, limit: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        from .pretokens import words_of

        merges, symbol, special = rules.value
        apart = regex.compile("|".join(regex.escape(x) for x in sorted(special, key=len, reverse=True))) if special else None
        words, known = words_of(pattern), {}
        for b in it:
            sizes, counts = [], []
            for text in texts_of(b.column("text")):
                sizes.append(len(text.encode()))
                # A special string in a text is one token by the library's default.
                extra, pieces = 0, [text]
                if apart is not None and any(x in text for x in special):
                    pieces = apart.split(text)
                    extra = len(pieces) - 1
                for piece in pieces:
                    found = words(piece)
                    try:
                        extra += sum(map(known.__getitem__, found))
                        continue
                    except KeyError:
                        pass
                    for w in found:
                        if w not in known:
                            known[w] = count_word(w.encode(), merges, symbol)
                    extra += sum(map(known.__getitem__, found))
                counts.append(extra)
                if len(known) > REMEMBERED:
                    known.clear()
            n = np.array(counts, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(n), pa.array(n > limit)], schema=SCHEMA)

    return run


def token_counts(spark: SparkSession, docs: DataFrame, path: str, pattern: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row, in no new order and without a shuffle.

    Null and empty texts have 0 tokens; repeated rows are counted each; a null
    doc_id stays null. The merge rules of a vocabulary are a fixed table, hence broadcast.
    """
    rules = spark.sparkContext.broadcast(load_merges(path))
    return text_rows(docs).mapInArrow(counter(rules, pattern, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
