"""Document quality from a linear-chain conditional random field over lines.

Each line is good (1) or bad (0). Its features are counts of its own characters and
words and those of the lines before and after it; the states of
adjacent lines are tied by transition weights. A document's quality is the
mean of the lines' forward-backward marginals, weighted by length, brought to a probability by
a logistic curve.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, batches, buffer_of, byte_table, held_out, spans, word_hashes
from .labels import labelled_sample, trained

#: Labelled rows of each class, and characters of each, from which the field is trained.
TRAIN_ROWS, TRAIN_CHARS = 1_500, 20_000
ROUNDS = 150
#: Weight of the good documents, all together, when the curve is fitted.
GOOD = 0.75

UPPER, LOWER, DIGIT, BLANK, BAR, MARK, SIGN, POINT, OTHER = range(9)


def classes() -> np.ndarray:
    """The kind of each byte."""
    to = np.full(256, OTHER, np.uint8)
    for kind, chars in ((UPPER, range(65, 91)), (LOWER, range(97, 123)), (DIGIT, range(48, 58)), (BLANK, SPACE.encode()), (POINT, b".,;:'\"()-?"), (BAR, b"|"), (MARK, b"!"), (SIGN, b"%*#$&@^~=+<>_{}[]\\/`")):
        to[list(chars)] = kind
    return to


KINDS, WORDS = classes(), byte_table(SPACE.encode())


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line (empty ones included), its length, and the lines of each document."""
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, offsets[1:]]))
    per_doc = 1 + np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1])
    kind = KINDS[data]
    size = (end - start).astype(np.float64)
    base = np.maximum(size, 1)
    share = {}
    for k in range(OTHER + 1):
        at = np.flatnonzero(kind == k)
        share[k] = (np.searchsorted(at, end) - np.searchsorted(at, start)) / base
    low = WORDS[data]
    ws, we = spans(low, offsets)
    h = word_hashes(low, ws, we)
    line = np.searchsorted(start, ws, side="right") - 1 if len(ws) else np.zeros(0, np.int64)
    words = np.bincount(line, minlength=len(start)).astype(np.float64)
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    repeat = np.bincount(line, weights=again, minlength=len(start)) / np.maximum(words, 1)
    letters = share[UPPER] + share[LOWER] + share[OTHER]
    loud = share[UPPER] / np.maximum(letters, 1e-9) * (letters > 0)
    odd = np.stack([loud, share[BAR], share[MARK], share[SIGN], repeat, share[DIGIT]], 1)
    curved = np.sqrt(odd)
    steps = odd > np.array([0.4, 0.01, 0.01, 0.03, 0.25, 0.2])
    own = np.concatenate([np.ones((len(start), 1)), odd, curved, steps, np.stack([share[POINT], share[BLANK]], 1)], 1)
    first = np.zeros(len(start), bool)
    if len(start):
        first[np.concatenate([np.zeros(1, np.int64), np.cumsum(per_doc)[:-1]])] = True
    last = np.roll(first, -1)
    near = np.concatenate([curved, steps], 1)
    before, after = np.roll(near, 1, 0), np.roll(near, -1, 0)
    before[first], after[last] = 0, 0
    return np.concatenate([own, before, after], 1), size, per_doc


def padded(scores: np.ndarray, per_doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of like line counts in rectangles: line numbers, mask; a rectangle has two million cells at most unless one document has more."""
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum(per_doc)[:-1]])
    order = np.argsort(per_doc, kind="stable")
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and (j + 1 - i) * per_doc[order[j]] <= 2_000_000 and per_doc[order[j]] <= 2 * per_doc[order[i]] + 8:
            j += 1
        own = order[i:j]
        width = int(per_doc[own].max())
        mask = np.arange(width)[None, :] < per_doc[own][:, None]
        yield np.where(mask, first[own][:, None] + np.arange(width)[None, :], 0), mask, own
        i = j


def forward_backward(unary: np.ndarray, mask: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginal of state 1 for each line, expected counts of state pairs, and the log partition sums' total. unary: the advantage of state 1."""
    n, width = unary.shape
    u = np.clip(unary, -30, 30)
    e = np.stack([np.exp(-u / 2), np.exp(u / 2)], 2)
    tie = np.exp(ties)
    alpha, beta = np.empty((n, width, 2)), np.ones((n, width, 2))
    scale = np.ones((n, width))
    for t in range(width):
        a = e[:, 0] if t == 0 else (alpha[:, t - 1] @ tie) * e[:, t]
        s = a.sum(1)
        live = mask[:, t]
        scale[:, t] = np.where(live, s, 1)
        alpha[:, t] = a / s[:, None] if t == 0 else np.where(live[:, None], a / s[:, None], alpha[:, t - 1])
    for t in range(width - 2, -1, -1):
        b = ((beta[:, t + 1] * e[:, t + 1]) @ tie.T) / scale[:, t + 1][:, None]
        beta[:, t] = np.where(mask[:, t + 1][:, None], b, 1)
    post = alpha * beta
    pairs = np.zeros((2, 2))
    if width > 1:
        right = beta[:, 1:] * e[:, 1:] / scale[:, 1:, None] * mask[:, 1:, None]
        pairs = np.einsum("nti,ntj->ij", alpha[:, :-1], right) * tie
    return post[:, :, 1] / post.sum(2), pairs, float((np.log(scale) * mask).sum())


class Field:
    """Weights w of the features, ties of the states, and the curve from mean marginal to probability."""

    def __init__(self, width: int):
        self.w, self.ties, self.curve = np.zeros(width), np.zeros((2, 2)), np.array([4.0, -2.0])

    def marginals(self, features: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        unary = features @ self.w
        out = np.zeros(len(features))
        for lines, mask, _ in padded(unary, per_doc):
            p, _, _ = forward_backward(unary[lines], mask, self.ties)
            out[lines[mask]] = p[mask]
        return out

    def means(self, features: np.ndarray, size: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        """Length-weighted mean marginal of each document."""
        doc = np.repeat(np.arange(len(per_doc)), per_doc)
        return np.bincount(doc, (size + 1) * self.marginals(features, per_doc), len(per_doc)) / np.bincount(doc, size + 1, len(per_doc))

    def scores(self, mean: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * mean + self.curve[1], -30, 30)))


def climb(gradient, size: int, rounds: int, rate: float) -> np.ndarray:
    """Adam from zero."""
    x, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, rounds + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return x


def train(rows: list[tuple[str, int]], rounds: int = ROUNDS) -> Field:
    """Lines of good documents are good. Of a bad document, the lines that look bad to a classifier
    of single lines are bad, one at least; the field learns from these labels."""
    texts = [t for t, _ in rows]
    data, offsets = buffer_of(pa.array(texts, pa.string()))
    x, size, per_doc = line_features(data, offsets)
    field = Field(x.shape[1])
    good = np.array([y for _, y in rows], bool)
    if not len(rows) or good.all() or not good.any():
        field.curve = np.array([0.0, 4.0 if good.all() else -4.0])  # one class alone: its constant
        return field
    doc = np.repeat(np.arange(len(rows)), per_doc)
    y = good[doc].astype(float)
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    own = np.arange(x.shape[1]) < 1 + 18 + 2  # those of the line itself
    for _ in range(2):
        w = climb(lambda w, y=y: x.T @ (weight * (y - 1 / (1 + np.exp(-np.clip(x @ (w * own), -30, 30))))) - 1e-4 * w, x.shape[1], rounds, 0.1)
        looks = x @ (w * own)
        worst = np.full(len(rows), np.inf)
        np.minimum.at(worst, doc, looks)
        y = np.where(good[doc], 1.0, ((looks > 0) & (looks > worst[doc])).astype(float))
    rect = list(padded(y, per_doc))
    seen = np.zeros((2, 2))
    for lines, mask, _ in rect:
        a, b = y[lines][:, :-1].astype(int), y[lines][:, 1:].astype(int)
        np.add.at(seen, (a[mask[:, 1:]], b[mask[:, 1:]]), 1)
    n = len(y)

    def gradient(p: np.ndarray) -> np.ndarray:
        unary, ties = x @ p[:-4], p[-4:].reshape(2, 2)
        got, pairs = np.zeros(n), np.zeros((2, 2))
        for lines, mask, _ in rect:
            m, q, _ = forward_backward(unary[lines], mask, ties)
            got[lines[mask]] = m[mask]
            pairs += q
        return np.concatenate([x.T @ (y - got) / n - 1e-4 * p[:-4], ((seen - pairs) / n - 1e-4 * ties).ravel()])

    p = climb(gradient, x.shape[1] + 4, rounds, 0.1)
    field.w, field.ties = p[:-4], p[-4:].reshape(2, 2)
    mean = field.means(x, size, per_doc)
    side = np.stack([mean, np.ones(len(mean))], 1)
    even = np.where(good, GOOD / good.sum(), (1 - GOOD) / (~good).sum())
    field.curve = climb(lambda c: side.T @ (even * (good - 1 / (1 + np.exp(-np.clip(side @ c, -30, 30))))) - 1e-5 * c, 2, 400, 0.2)
    return field


def score(docs: DataFrame, labels: DataFrame, held: tuple[int, int] = (4, 2), threshold: float = 0.7, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted, n_lines, n_bad (lines whose marginal is under a half), for each row of docs.

    Null and empty texts are one empty line and get its score; without labels, or with one
    class alone, all get a constant; repeated rows each return; ids may be null.
    """
    spark = docs.sparkSession
    field = spark.sparkContext.broadcast(trained(labelled_sample(docs, labels, "quality", held, train_rows, TRAIN_CHARS), train))
    names = ["doc_id", "held_out", "score", "predicted", "n_lines", "n_bad"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = field.value
        for b in batches(it):
            x, size, per_doc = line_features(*buffer_of(b.column("text")))
            p = f.marginals(x, per_doc)
            doc = np.repeat(np.arange(len(per_doc)), per_doc)
            mean = np.bincount(doc, (size + 1) * p, len(per_doc)) / np.maximum(np.bincount(doc, size + 1, len(per_doc)), 1e-9)
            s = f.scores(mean)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32)), pa.array(per_doc), pa.array(np.bincount(doc, p < 0.5, len(per_doc)).astype(np.int64))], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), *held).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_lines long, n_bad long")
