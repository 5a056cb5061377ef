"""Document quality from a linear-chain conditional random field over lines.

Every line with a non-space character is a node labelled good or bad. Its
features are shares of byte classes and of repeated words, its length, and the
same features of the line before and after; a pair of labels of neighbouring
lines has a weight of its own, as have the labels at a text's ends. Forward and
backward sums give each line's probability of being good; the document's score is
their mean, weighted by the lines' lengths in bytes.

Training maximises the likelihood of the label paths (a document's label is
that of each of its lines) with Adam in numpy, on at most ``PER_CLASS``
documents of each quality by the smallest hash of doc_id, never of the held-out
fold. Features come from the text alone. The weights are about fifty numbers and
are broadcast; scoring is one pass over the texts, vectorised over the lines of
many documents, without a shuffle.

Defined results: a text that is null, empty or blank is one line without
features; it is scored by the end and bias weights. Without labels of both
kinds every score is 0.5. Repeated rows get the same score; repeated labels
count once; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, sample_per_class, slices, table

PER_CLASS = 500
THRESHOLD = 0.7
STEPS = 250
RATE = 0.1
DECAY = 1e-4              # weight of the squared weights in the loss

_CLASSES = ("upper", "lower", "digit", "symbol", "bar", "shout", "other", "space", "high")
_CLASS = np.full(256, _CLASSES.index("other"), dtype=np.uint8)
_CLASS[ord("A"):ord("Z") + 1] = _CLASSES.index("upper")
_CLASS[ord("a"):ord("z") + 1] = _CLASSES.index("lower")
_CLASS[ord("0"):ord("9") + 1] = _CLASSES.index("digit")
_CLASS[128:] = _CLASSES.index("high")
for _c in b"#*$%&<>~^_=+@\\{}[]":
    _CLASS[_c] = _CLASSES.index("symbol")
_CLASS[ord("|")] = _CLASSES.index("bar")
_CLASS[ord("!")] = _CLASS[ord("?")] = _CLASSES.index("shout")
for _c in b" \t\r\x0b\x0c":
    _CLASS[_c] = _CLASSES.index("space")
BASE = 12                 # features of one line


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes) of all lines, and the line offsets of the texts (one
    more than texts). A text without any visible line has one empty line."""
    parts = [b"\n" if t is None else t.encode("utf-8", "surrogatepass") + b"\n" for t in texts]
    buf = np.frombuffer(b"".join(parts), dtype=np.uint8)
    text_end = np.cumsum([len(p) for p in parts])
    end = np.flatnonzero(buf == 10)
    start = np.concatenate([[0], end[:-1] + 1])
    kind = _CLASS[buf]
    kind[end] = _CLASSES.index("space")
    counts = np.empty((len(end), len(_CLASSES)), np.float64)
    for c in range(len(_CLASSES)):
        upto = np.concatenate([[0], np.cumsum(kind == c, dtype=np.int64)])
        counts[:, c] = upto[end] - upto[start]
    size = (end - start).astype(np.float64)
    seen = size - counts[:, _CLASSES.index("space")] > 0

    # words: begin where a visible byte follows a space; compare with up to three before in the line
    space = kind == _CLASSES.index("space")
    begin = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    stop = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    with np.errstate(over="ignore"):
        value = np.concatenate([np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _spread(len(buf)), dtype=np.uint64)])
        word = (value[stop] - value[begin]) * _unspread(begin) + (stop - begin).astype(np.uint64)
    line = np.searchsorted(end, begin)
    n_words = np.bincount(line, minlength=len(end)).astype(np.float64)
    again = np.zeros(len(begin), dtype=bool)
    for lag in (1, 2, 3):
        if len(begin) > lag:
            again[lag:] |= (word[lag:] == word[:-lag]) & (line[lag:] == line[:-lag])
        if lag == 1:
            twice = np.bincount(line[again], minlength=len(end))
    repeated = np.bincount(line[again], minlength=len(end))
    first_upper = np.bincount(line[kind[begin] == _CLASSES.index("upper")], minlength=len(end))

    count = {c: counts[:, i] for i, c in enumerate(_CLASSES)}
    chars, words = np.maximum(size - count["space"], 1), np.maximum(n_words, 1)
    letters = np.maximum(count["upper"] + count["lower"] + count["high"], 1)
    feats = np.column_stack([
        # what is rare in plain prose, saturating: some of it says as much as a lot
        np.tanh(4 * np.maximum(count["upper"] / letters - 0.15, 0)), np.tanh(2 * count["symbol"] / words),
        np.tanh(3 * count["bar"] / words), np.tanh(2 * count["shout"] / words),
        np.tanh(6 * np.maximum(twice / words - 0.05, 0)), np.tanh(6 * np.maximum(repeated / words - 0.15, 0)),
        count["digit"] / chars, count["other"] / chars, count["high"] / chars,
        first_upper / words, np.minimum(np.log1p(n_words) / 4, 2), np.minimum(chars / words / 8, 3),
    ])
    text = np.searchsorted(text_end, end, side="right")
    keep = seen.copy()
    blank = np.ones(len(texts), dtype=bool)
    blank[text[seen]] = False
    last = np.searchsorted(end, text_end - 1)
    keep[last[blank]] = True
    feats[last[blank]] = 0
    size = np.where(seen, size, 1.0)
    offsets = np.searchsorted(text[keep], np.arange(len(texts) + 1))
    return feats[keep], size[keep], offsets


_POW = np.ones(1, dtype=np.uint64)
_INV = np.ones(1, dtype=np.uint64)
_ODD = 0x9E3779B97F4A7C15


def _grow(n: int) -> None:
    global _POW, _INV
    if len(_POW) < n:
        size = 1 << (n - 1).bit_length()
        one = [np.uint64(1)]
        _POW = np.cumprod(np.concatenate([one, np.full(size - 1, np.uint64(_ODD))]), dtype=np.uint64)
        _INV = np.cumprod(np.concatenate([one, np.full(size - 1, np.uint64(pow(_ODD, -1, 1 << 64)))]), dtype=np.uint64)


def _spread(n: int) -> np.ndarray:
    _grow(n)
    return _POW[:n]


def _unspread(at: np.ndarray) -> np.ndarray:
    return _INV[at]


def with_neighbours(feats: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after in its text, and a bias."""
    n = len(feats)
    before, after = np.zeros_like(feats), np.zeros_like(feats)
    if n > 1:
        before[1:], after[:-1] = feats[:-1], feats[1:]
    before[offsets[:-1]] = 0
    after[offsets[1:] - 1] = 0
    return np.hstack([feats, before, after, np.ones((n, 1))])


class LineCrf:
    """Two labels (0 bad, 1 good); ``w`` scores good, ``pair`` neighbouring labels, ``ends`` the labels at both ends."""

    def __init__(self):
        self.w = np.zeros(3 * BASE + 1)
        self.pair = np.zeros((2, 2))
        self.ends = np.zeros((2, 2))

    def _chains(self, offsets: np.ndarray):
        """Texts by falling length, and per step how many are still running."""
        length = np.diff(offsets)
        order = np.argsort(-length, kind="stable")
        running = np.searchsorted(-length[order], -np.arange(length.max(initial=0)), side="left")
        return offsets[:-1][order], length[order], running

    def forward_backward(self, unary: np.ndarray, offsets: np.ndarray):
        """(log marginals of good and bad per line, log marginals of label pairs of neighbours
        indexed by the later line, log partition per text in offset order)."""
        score = np.column_stack([np.zeros(len(unary)), unary])
        first, length, running = self._chains(offsets)
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        lse = np.logaddexp
        alpha[first] = score[first] + self.ends[0]
        for t in range(1, len(running)):
            at = first[:running[t]] + t
            p = alpha[at - 1]
            alpha[at] = score[at] + np.column_stack([lse(p[:, 0] + self.pair[0, k], p[:, 1] + self.pair[1, k]) for k in (0, 1)])
        beta[first + length - 1] = self.ends[1]
        for t in range(len(running) - 1, 0, -1):
            at = first[:running[t]] + t
            n = beta[at] + score[at]
            beta[at - 1] = np.column_stack([lse(n[:, 0] + self.pair[k, 0], n[:, 1] + self.pair[k, 1]) for k in (0, 1)])
        total = alpha + beta
        log_z = lse(total[:, 0], total[:, 1])
        inner = np.ones(len(unary), dtype=bool)
        inner[offsets[:-1]] = False
        at = np.flatnonzero(inner)
        pairs = alpha[at - 1][:, :, None] + self.pair[None] + (beta[at] + score[at])[:, None, :] - log_z[at][:, None, None]
        return total - log_z[:, None], pairs, log_z

    def fit(self, x: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> LineCrf:
        """Adam on the negative log-likelihood, each text weighing alike within its label."""
        length = np.diff(offsets)
        y = np.repeat(labels, length)
        share = 1.0 / np.maximum(np.bincount(labels, minlength=2), 1)[labels] / 2
        weight = np.repeat(share / length, length)
        inner = np.ones(len(x), dtype=bool)
        inner[offsets[:-1]] = False
        at = np.flatnonzero(inner)
        params = [self.w, self.pair, self.ends]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, STEPS + 1):
            single, pairs, _ = self.forward_backward(x @ self.w, offsets)
            gap = weight * (np.exp(single[:, 1]) - y)
            expected = (np.exp(pairs) * weight[at][:, None, None]).sum(axis=0)
            np.subtract.at(expected, (y[at - 1], y[at]), weight[at])
            ends = np.zeros((2, 2))
            for side, rows in ((0, offsets[:-1]), (1, offsets[1:] - 1)):
                ends[side] = (np.exp(single[rows]) * weight[rows][:, None]).sum(axis=0)
                np.subtract.at(ends[side], y[rows], weight[rows])
            grads = [x.T @ gap + DECAY * self.w, expected + DECAY * self.pair, ends + DECAY * self.ends]
            for p, g, a, b in zip(params, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-9)
        return self

    def quality(self, texts: list[str | None]) -> np.ndarray:
        """Length-weighted mean of the lines' probability of being good."""
        feats, size, offsets = line_features(texts)
        single, _, _ = self.forward_backward(with_neighbours(feats, offsets) @ self.w, offsets)
        good = np.exp(single[:, 1])
        return np.clip(np.add.reduceat(good * size, offsets[:-1]) / np.add.reduceat(size, offsets[:-1]), 0, 1)


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> list[tuple[str | None, int]]:
    """(text, quality) of the bounded sample, outside the held-out fold."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    lab = lab.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    ids = sample_per_class(lab, "quality", "doc_id", per_class)              # at most 2 * per_class rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # rows that share an id count once, with their least text
    got = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text")).toArrow().to_pylist()
    return [(r["text"], r["quality"]) for r in sorted(got, key=lambda r: (r["doc_id"], r["quality"], r["text"] or ""))]


def fitted(samples: list[tuple[str | None, int]]) -> LineCrf:
    crf = LineCrf()
    if {q for _, q in samples} == {0, 1}:
        feats, _, offsets = line_features([t for t, _ in samples])
        crf.fit(with_neighbours(feats, offsets), offsets, np.array([q for _, q in samples]))
    return crf


def scored(docs: DataFrame, crf: LineCrf, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(crf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b, "text"):
                s = b.slice(lo, hi - lo)
                q = model.value.quality(s.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [s.column("doc_id"), s.column("held_out"), pa.array(q), pa.array((q >= threshold).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"),
                      F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op8_line_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fitted(training_sample(docs, table(spark, sf_dir, "labels"))))
