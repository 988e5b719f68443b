"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters the network as its own hashed vector beside the mean of the
hashed vectors of its character n-grams (edges marked), so an unseen ending of a known
stem still speaks. Texts are cut into overlapping windows of words; each window
is read in both directions, its states are pooled by attention, and the document's
score is that of its highest window. Training is plain numpy on a bounded sample: in
every round the highest window of each document carries the document's label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, buffer_of, byte_table, held_out, rows_of, spans, word_hashes
from .labels import labelled_sample, trained

WINDOW, STRIDE = 32, 16
HIDDEN, WIDTH = 8, 8  # states of a direction; numbers of a word's and of an n-gram's vector
WORD_BITS, GRAM_BITS, GRAMS = 13, 14, (3, 4, 5)
#: Labelled rows of each class, and characters of each, for training; rounds and windows of a step.
TRAIN_ROWS, TRAIN_CHARS, ROUNDS, STEP = 2_000, 20_000, 12, 64
#: Bytes of text, and windows, that a task holds at once.
SLICE_BYTES, SLICE_WINDOWS = 1_000_000, 2_048
#: Words are what stands between ASCII white space and punctuation.
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
TABLE = byte_table(SEPARATORS)


class Words:
    """Distinct words of a stretch of text: which each word is, its bucket, and the buckets of its n-grams."""

    def __init__(self, low: np.ndarray, start: np.ndarray, end: np.ndarray):
        h = word_hashes(low, start, end)
        distinct, first, self.which = np.unique(h, return_index=True, return_inverse=True)
        self.bucket = (distinct >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        s, size = start[first], (end - start)[first]
        # Each distinct word between two edge marks, one after the other.
        own = size + 2
        at = np.cumsum(own) - own
        text = np.full(int(own.sum()) + 8, 1, np.uint8)
        body = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        text[np.repeat(at + 1, size) + body] = low[np.repeat(s, size) + body]
        eight = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
        words, buckets = [], []
        for n in GRAMS:
            many = np.maximum(own - n + 1, 0)
            place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            code = eight[np.repeat(at, many) + place] & np.uint64((1 << 8 * n) - 1)
            code = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(31)
            words.append(np.repeat(np.arange(len(own)), many))
            buckets.append(((code * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64))
        self.word, self.gram = np.concatenate(words), np.concatenate(buckets)
        self.grams = np.maximum(np.bincount(self.word, minlength=len(own)), 1).astype(np.float32)

    def __len__(self) -> int:
        return len(self.bucket)


def windows(per_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, words and document of every window; a document without words has one empty window."""
    many = np.maximum(1, 1 + -(-(per_doc - WINDOW) // STRIDE))
    doc = np.repeat(np.arange(len(per_doc)), many)
    turn = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    size = np.clip(per_doc[doc] - turn * STRIDE, 0, WINDOW)
    return (np.cumsum(per_doc) - per_doc)[doc] + turn * STRIDE, size, doc


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def read(x: np.ndarray, u: np.ndarray, mask: np.ndarray, order: range, keep: list | None = None) -> np.ndarray:
    """Run one direction over projected inputs x (windows, words, 3 * HIDDEN); states for each word."""
    n = len(x)
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((n, x.shape[1], HIDDEN), np.float32)
    for t in order:
        a, live = h @ u, mask[:, t, None]
        gates = sigmoid(x[:, t, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
        z, r, q = gates[:, :HIDDEN], gates[:, HIDDEN:], a[:, 2 * HIDDEN :]
        c = np.tanh(x[:, t, 2 * HIDDEN :] + r * q)
        if keep is not None:
            keep.append((t, h, z, r, q, c))
        h = h + live * (1 - z) * (c - h)
        out[:, t] = h
    return out


class Network:
    NAMES = ("words", "grams", "inp", "bias", "u0", "u1", "look", "top", "level")

    def __init__(self, seed: int = 7):
        g = np.random.default_rng(seed)
        r = lambda *s, scale: (g.standard_normal(s) * scale).astype(np.float32)
        self.words, self.grams = r(1 << WORD_BITS, WIDTH, scale=0.1), r(1 << GRAM_BITS, WIDTH, scale=0.3)
        self.inp, self.bias = r(2 * WIDTH, 6 * HIDDEN, scale=0.3), np.zeros(6 * HIDDEN, np.float32)
        self.u0, self.u1 = r(HIDDEN, 3 * HIDDEN, scale=0.3), r(HIDDEN, 3 * HIDDEN, scale=0.3)
        self.look, self.top, self.level = r(2 * HIDDEN, scale=0.3), r(2 * HIDDEN, scale=0.3), np.zeros(1, np.float32)

    def vectors(self, w: Words) -> np.ndarray:
        chars = np.stack([np.bincount(w.word, self.grams[w.gram, k], len(w)) for k in range(WIDTH)], 1) / w.grams[:, None] if len(w) else np.zeros((0, WIDTH))
        return np.concatenate([self.words[w.bucket], chars.astype(np.float32)], 1)

    def pooled(self, x: np.ndarray, mask: np.ndarray, keep: tuple | None = None) -> tuple[np.ndarray, ...]:
        k, steps = keep or (None, None), x.shape[1]
        states = np.concatenate([read(x[:, :, : 3 * HIDDEN], self.u0, mask, range(steps), k[0]), read(x[:, :, 3 * HIDDEN :], self.u1, mask, range(steps - 1, -1, -1), k[1])], 2)
        e = np.where(mask > 0, states @ self.look, -1e4)
        e = np.exp(e - e.max(1, keepdims=True)) * mask
        e = e / np.maximum(e.sum(1, keepdims=True), 1e-9)
        pool = np.einsum("nt,nth->nh", e, states)
        return pool @ self.top + self.level[0], states, e, pool

    def inputs(self, which: np.ndarray, first: np.ndarray, size: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = int(size.max(initial=1)) or 1
        t = np.arange(width)
        mask = (t < size[:, None]).astype(np.float32)
        place = np.where(mask > 0, which[np.minimum(first[:, None] + t, max(len(which) - 1, 0))] if len(which) else 0, 0)
        return (table[place] if len(table) else np.zeros((*place.shape, 6 * HIDDEN), np.float32)), mask, place

    def logits(self, w: Words, first: np.ndarray, size: np.ndarray, chunk: int = SLICE_WINDOWS) -> np.ndarray:
        """Of every window."""
        table = self.vectors(w) @ self.inp + self.bias
        out = np.zeros(len(first), np.float32)
        order = np.argsort(-size, kind="stable")  # short windows run together and stop early
        for i in range(0, len(first), chunk):
            own = order[i : i + chunk]
            x, mask, _ = self.inputs(w.which, first[own], size[own], table)
            out[own] = self.pooled(x, mask)[0]
        return out

    def gradients(self, w: Words, first: np.ndarray, size: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss of some windows."""
        used, which = np.unique(np.concatenate([w.which[a : a + n] for a, n in zip(first, size, strict=True)] or [np.zeros(0, np.int64)]), return_inverse=True)
        row = np.full(len(w), -1)
        row[used] = np.arange(len(used))
        mine = row[w.word] >= 0 if len(w) else np.zeros(0, bool)
        word, gram, many = row[w.word[mine]], w.gram[mine], w.grams[used]
        chars = np.stack([np.bincount(word, self.grams[gram, k], len(used)) for k in range(WIDTH)], 1) / many[:, None]
        v = np.concatenate([self.words[w.bucket[used]], chars.astype(np.float32)], 1)
        starts = np.cumsum(size) - size
        x, mask, place = self.inputs(which, starts, size, v @ self.inp + self.bias)
        kept: tuple[list, list] = ([], [])
        logit, states, e, pool = self.pooled(x, mask, kept)
        d = weight * (sigmoid(logit) - y)
        out = {"top": pool.T @ d, "level": d.sum(keepdims=True)}
        dpool = d[:, None] * self.top
        de = np.einsum("nth,nh->nt", states, dpool)
        de = e * (de - (e * de).sum(1, keepdims=True))
        out["look"] = np.einsum("nt,nth->h", de, states)
        dstates = e[:, :, None] * dpool[:, None, :] + de[:, :, None] * self.look
        dx = np.zeros_like(x)
        for side, (u, name) in enumerate(((self.u0, "u0"), (self.u1, "u1"))):
            du, dh = np.zeros_like(u), np.zeros((len(x), HIDDEN), np.float32)
            for t, h, z, r, q, c in reversed(kept[side]):
                dh = dh + dstates[:, t, side * HIDDEN : (side + 1) * HIDDEN]
                new = dh * mask[:, t, None]
                dc = new * (1 - z) * (1 - c * c)
                dz, dr = new * (h - c) * z * (1 - z), dc * q * r * (1 - r)
                back = np.concatenate([dz, dr, dc * r], 1)
                dx[:, t, side * 3 * HIDDEN : (side + 1) * 3 * HIDDEN] = np.concatenate([dz, dr, dc], 1)
                du += h.T @ back
                dh = dh - new * (1 - z) + back @ u.T
            out[name] = du
        live = mask > 0
        flat, at = dx[live], place[live]
        table = np.zeros((len(used), 6 * HIDDEN), np.float32)
        np.add.at(table, at, flat)
        out["bias"], out["inp"] = table.sum(0), v.T @ table
        dv = table @ self.inp.T
        out["words"], out["grams"] = np.zeros_like(self.words), np.zeros_like(self.grams)
        np.add.at(out["words"], w.bucket[used], dv[:, :WIDTH])
        np.add.at(out["grams"], gram, (dv[:, WIDTH:] / many[:, None])[word])
        return out


def tokens(column: pa.Array) -> tuple[Words, np.ndarray]:
    data, offsets = buffer_of(column)
    low = TABLE[data]
    start, end = spans(low, offsets)
    return Words(low, start, end), np.bincount(rows_of(start, offsets), minlength=len(offsets) - 1)


def highest(logit: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The window of each document with the highest score; documents are in order and each has a window."""
    order = np.lexsort((-logit, doc))
    return order[np.searchsorted(doc[order], np.arange(doc[-1] + 1))]


def train(rows: list[tuple[str, int]], rounds: int = ROUNDS, seed: int = 7) -> Network:
    net = Network(seed)
    if len({y for _, y in rows}) < 2:
        net.top[:] = 0  # one class alone teaches its constant
        net.level[0] = 4.0 if rows and rows[0][1] else -4.0
        return net
    w, per_doc = tokens(pa.array([t for t, _ in rows], pa.string()))
    first, size, doc = windows(per_doc)
    y = np.array([v for _, v in rows], np.float32)
    moments = {k: (np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))) for k in Network.NAMES}
    g, step = np.random.default_rng(seed), 0
    for turn in range(rounds):
        # The first round has no opinion yet: any window may be the one.
        logit = net.logits(w, first, size) if turn else g.standard_normal(len(first)).astype(np.float32)
        top = highest(logit, doc)
        # Of clean documents a second window is a sure negative too.
        more = g.choice(np.flatnonzero(y[doc] == 0), int((y == 0).sum()))
        pick = g.permutation(np.concatenate([top, more]))
        for i in range(0, len(pick), STEP):
            own = pick[i : i + STEP]
            grads = net.gradients(w, first[own], size[own], y[doc[own]], np.full(len(own), 1 / len(own), np.float32))
            step += 1
            rate = 0.01 * (0.3 if turn >= rounds * 2 // 3 else 1)
            for k, grad in grads.items():
                m, v = moments[k]
                value = getattr(net, k)
                grad = grad + 1e-5 * value
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


SCORES = "doc_id long, held_out boolean, score double, predicted int, n_windows long"


def score(docs: DataFrame, labels: DataFrame, held: tuple[int, int] = (5, 0), threshold: float = 0.5, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted, n_windows, for each row of docs.

    Null and empty texts, and texts without words, are one empty window; without labels, or
    with one class alone, all get a constant; repeated rows each return; ids may be null.
    """
    spark = docs.sparkSession
    network = spark.sparkContext.broadcast(trained(labelled_sample(docs, labels, "toxic", held, train_rows, TRAIN_CHARS), train))
    names = ["doc_id", "held_out", "score", "predicted", "n_windows"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = network.value
        for b in batches(it, SLICE_BYTES):
            w, per_doc = tokens(b.column("text"))
            first, size, doc = windows(per_doc)
            logit = net.logits(w, first, size).astype(np.float64)
            s = sigmoid(logit[highest(logit, doc)]) if len(doc) else np.zeros(0)
            cols = [b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32)), pa.array(np.bincount(doc, minlength=len(per_doc)).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), *held).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCORES)


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs without the rows scored toxic. Scoring runs inside the rows' own tasks: no join, no shuffle."""
    spark, columns = docs.sparkSession, docs.columns
    network = spark.sparkContext.broadcast(trained(labelled_sample(docs, labels, "toxic", (5, 0), TRAIN_ROWS, TRAIN_CHARS), train))
    at = columns.index("text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = network.value
        for b in batches(it, SLICE_BYTES):
            w, per_doc = tokens(b.column(at).cast(pa.string()))
            first, size, doc = windows(per_doc)
            logit = net.logits(w, first, size).astype(np.float64)
            if len(doc):
                yield b.filter(pa.array(sigmoid(logit[highest(logit, doc)]) < threshold))

    return docs.mapInArrow(run, docs.schema)
