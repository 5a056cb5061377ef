"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word, letter case folded, one GRU from the
left and one from the right; at every byte position the two states give
log-probabilities of the languages. A document's score pools the positions:
the log-probabilities of all positions of all its words are added up, divided by
``TEMPER`` (neighbouring positions aren't independent), and normalised. States start anew
at every word, and a word of over ``PIECE`` bytes is read in pieces, so what a
position says depends on its piece alone. A worker therefore runs each piece
once and remembers its sum; a text's own cost is a lookup per word. Words are
letters with their combining marks, of the whole text; digits, punctuation and
white space say nothing about a language here and aren't read.

Training is backpropagation through time in numpy with Adam, on a documented,
bounded sample: at most ``PER_LANGUAGE`` documents of each language by the
smallest hash of doc_id, never of the held-out fold, and at most ``WORDS`` of
each language's commonest and evenly spread words. Rows that share a doc_id are one
sample, with their least text. A document's label is every
position's label. Weights are a few thousand numbers, which are broadcast.

Defined results: null texts and texts without any letter are ``und`` with
score 0; languages are those of the sample (none: all are ``und``); repeated
rows give repeated results; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, sample_per_class, slices, table

PER_LANGUAGE = 120        # documents a language
WORDS = 4000              # distinct words a language
SPOT_WORDS = 40_000       # words of a text that training looks at, spread over it
HIDDEN = 12
EMBED = 8
PIECE = 24                # bytes of a piece
EPOCHS = 5
BATCH = 256
STEPS = 200               # at least, however small the sample
RATE = 0.01
TEMPER = 4.0
CACHE = 800_000           # words a worker remembers
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")   # letters with the marks that follow them


class GruNet:
    """Two GRUs and a softmax, forward and backward, over padded byte batches."""

    def __init__(self, classes: int, rng: np.random.Generator):
        def w(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        p = {"E": w(256, EMBED) * np.float32(4)}
        for d in "fb":
            p |= {f"W{d}": w(EMBED, 3 * HIDDEN), f"U{d}": w(HIDDEN, 3 * HIDDEN), f"a{d}": np.zeros(3 * HIDDEN, np.float32)}
        p |= {"V": w(2 * HIDDEN, classes), "c": np.zeros(classes, np.float32)}
        self.p = p

    @staticmethod
    def _sigmoid(x):
        return 0.5 + 0.5 * np.tanh(0.5 * x)

    def _run(self, x, mask, d):
        """States after every position; ``x`` are byte embeddings (T, N, E)."""
        p, h = self.p, HIDDEN
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        state = np.zeros((x.shape[1], h), np.float32)
        states, kept = np.zeros((len(x), x.shape[1], h), np.float32), {}
        inputs = x @ p[f"W{d}"] + p[f"a{d}"]
        for t in steps:
            u = state @ p[f"U{d}"]
            zr = self._sigmoid(inputs[t][:, :2 * h] + u[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            n = np.tanh(inputs[t][:, 2 * h:] + r * u[:, 2 * h:])
            m = mask[t][:, None]
            new = state + m * (1 - z) * (n - state)
            kept[t] = (state, z, r, n, u[:, 2 * h:])
            state = states[t] = new
        return states, kept

    def log_probs(self, seq, mask):
        """(T, N, classes) log-probabilities at every position."""
        x = self.p["E"][seq]
        f, kf = self._run(x, mask, "f")
        b, kb = self._run(x, mask, "b")
        both = np.concatenate([f, b], axis=2)
        s = both @ self.p["V"] + self.p["c"]
        s -= s.max(axis=2, keepdims=True)
        s -= np.log(np.exp(s).sum(axis=2, keepdims=True))
        return s, (x, both, kf, kb)

    def gradients(self, seq, mask, label, weight):
        """Loss and its gradients: cross entropy of every position, back through time."""
        p, h = self.p, HIDDEN
        s, (x, both, kf, kb) = self.log_probs(seq, mask)
        w = mask * weight / (mask * weight).sum()
        loss = -(s[:, np.arange(len(label)), label] * w).sum()
        ds = np.exp(s)
        ds[:, np.arange(len(label)), label] -= 1
        ds *= w[:, :, None]
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["V"] = both.reshape(-1, 2 * h).T @ ds.reshape(-1, ds.shape[2])
        g["c"] = ds.sum(axis=(0, 1))
        dboth = ds @ p["V"].T
        dx = np.zeros_like(x)
        for d, kept, part in (("f", kf, dboth[:, :, :h]), ("b", kb, dboth[:, :, h:])):
            steps = range(len(x) - 1, -1, -1) if d == "f" else range(len(x))
            carry = np.zeros_like(part[0])
            for t in steps:
                state, z, r, n, un = kept[t]
                m = mask[t][:, None]
                dn_state = carry + part[t] * m
                dh = dn_state * (1 - m * (1 - z))
                dn = dn_state * m * (1 - z) * (1 - n * n)
                dz = dn_state * m * (state - n) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                gates = np.concatenate([dz, dr, dn], axis=1)
                inner = np.concatenate([dz, dr, dn * r], axis=1)
                g[f"W{d}"] += x[t].T @ gates
                g[f"a{d}"] += gates.sum(axis=0)
                g[f"U{d}"] += state.T @ inner
                dx[t] += gates @ p[f"W{d}"].T
                carry = dh + inner @ p[f"U{d}"].T
        np.add.at(g["E"], seq.ravel(), dx.reshape(-1, EMBED))
        return loss, g


def padded(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(T, N) bytes and mask."""
    t = max(map(len, pieces))
    flat = np.frombuffer(b"".join(p.ljust(t, b"\0") for p in pieces), dtype=np.uint8).reshape(len(pieces), t).T
    n = np.array([len(p) for p in pieces])
    return flat, (np.arange(t)[:, None] < n).astype(np.float32)


def pieces_of(word: str) -> list[bytes]:
    """A word's bytes between marks, cut between characters to ``PIECE`` bytes at most."""
    raw = b"^" + word.encode("utf-8", "surrogatepass") + b"$"
    out, at = [], 0
    while at < len(raw):
        end = min(at + PIECE, len(raw))
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        out.append(raw[at:end])
        at = end
    return out


def words_of(text: str | None) -> list[str]:
    """Runs of letters with their combining marks, lower-cased."""
    return [] if text is None else _LETTERS.findall(text.lower())


def train(samples: list[tuple[str, str]], seed: int = 7) -> tuple[GruNet | None, list[str]]:
    """Network and languages from (text, language) pairs."""
    langs = sorted({lang for _, lang in samples})
    if not langs:
        return None, []
    rng = np.random.default_rng(seed)
    net = GruNet(len(langs), rng)
    seq, label, weight = [], [], []
    for k, lang in enumerate(langs):
        seen: Counter = Counter()
        for text, own in samples:
            if own == lang:
                w = words_of(text)
                seen.update(w[::max(1, len(w) // SPOT_WORDS)])
        ranked = sorted(seen, key=lambda w: (-seen[w], w))
        spread = ranked if len(ranked) <= WORDS else ranked[:WORDS // 2] + [ranked[i] for i in np.linspace(WORDS // 2, len(ranked) - 1, WORDS - WORDS // 2).astype(int)]
        for w in spread:
            for p in pieces_of(w):
                seq.append(p)
                label.append(k)
                weight.append(1 + np.log(seen[w]))
    label, weight = np.array(label), np.array(weight, np.float32)
    moment = {k: np.zeros_like(v) for k, v in net.p.items()}
    square = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    batches = -(-len(seq) // BATCH)
    epochs = max(EPOCHS, -(-STEPS // max(1, batches)))
    for epoch in range(epochs):
        order = rng.permutation(len(seq))
        order = np.concatenate([chunk[np.argsort([len(seq[i]) for i in chunk], kind="stable")] for chunk in np.array_split(order, max(1, len(order) // (BATCH * 16)))])
        starts = rng.permutation(batches)
        for b in starts:
            at = order[b * BATCH:(b + 1) * BATCH]
            x, m = padded([seq[i] for i in at])
            _, g = net.gradients(x, m, label[at], weight[at])
            step += 1
            rate = RATE * (1 - 0.9 * step / (epochs * batches + 1))
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            for k, v in g.items():
                v = v * min(1.0, 1.0 / (norm + 1e-9))
                moment[k] += 0.1 * (v - moment[k])
                square[k] += 0.01 * (v * v - square[k])
                net.p[k] -= (rate * moment[k] / (1 - 0.9 ** step) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net, langs


class Scorer:
    """Pooled log-probabilities of documents; remembers the words it has run."""

    def __init__(self, net: GruNet, classes: int, cache: int = CACHE):
        self.net, self.classes, self.most = net, classes, cache
        self.at: dict[str, int] = {}
        self.sums = np.zeros((0, classes), np.float32)

    def _learn(self, words: list[str]) -> None:
        pieces, owner = [], []
        for i, w in enumerate(words):
            for p in pieces_of(w):
                pieces.append(p)
                owner.append(i)
        order = np.argsort([len(p) for p in pieces], kind="stable")
        owner = np.array(owner)
        out = np.zeros((len(words), self.classes), np.float32)
        for i in range(0, len(order), 2048):
            some = order[i:i + 2048]
            seq, mask = padded([pieces[k] for k in some])
            s, _ = self.net.log_probs(seq, mask)
            np.add.at(out, owner[some], (s * mask[:, :, None]).sum(axis=0))
        self.at.update(zip(words, range(len(self.at), len(self.at) + len(words))))
        self.sums = np.concatenate([self.sums, out])

    def score(self, texts: list[str | None]) -> list[tuple[int, float]]:
        """(class or -1, its probability) of each text."""
        words = [words_of(t) for t in texts]
        new = set().union(*words).difference(self.at)
        if len(self.at) + len(new) > self.most:
            self.at, self.sums = {}, self.sums[:0]
            new = set().union(*words)
        if new:
            self._learn(sorted(new))
        out = []
        for ws in words:
            if not ws:
                out.append((-1, 0.0))
                continue
            s = self.sums[np.fromiter(map(self.at.__getitem__, ws), np.int64, len(ws))].sum(axis=0, dtype=np.float64) / TEMPER
            e = np.exp(s - s.max())
            k = int(e.argmax())
            out.append((k, float(e[k] / e.sum())))
        return out


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """(text, language) of the bounded sample, outside the held-out fold."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    ids = sample_per_class(rows, "lang", "doc_id", per_language)
    # ids: per_language a language; rows that share an id count once, with their least text
    got = rows.join(F.broadcast(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).toArrow()
    return [(t, k) for _, k, t in sorted(zip(*[got.column(c).to_pylist() for c in ("doc_id", "lang", "text")]))]


def identify(docs: DataFrame, samples: list[tuple[str, str]]) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""
    net, langs = train(samples)
    model = docs.sparkSession.sparkContext.broadcast((net, langs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net_, langs_ = model.value
        scorer = Scorer(net_, len(langs_)) if langs_ else None
        for b in batches:
            for lo, hi in slices(b, "text"):
                s = b.slice(lo, hi - lo)
                texts = s.column("text").to_pylist()
                got = scorer.score(texts) if scorer else [(-1, 0.0)] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [s.column("doc_id"), s.column("held_out"), pa.array(["und" if k < 0 else langs_[k] for k, _ in got], pa.string()),
                     pa.array([x for _, x in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"),
                      F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, training_sample(docs))
