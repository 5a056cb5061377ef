"""Importance resampling of documents towards a target's hashed word counts.

Words come from the tokenizers library: an untrained pre-tokeniser, one ``Split``
by a regular expression over the text with A-Z lower-cased, returns every word
with its offsets. Features are all runs of 1 to ``runs`` consecutive words joined
by one space: windows from the start offset of a word to the end offset of a
later one in the words joined by single spaces. A feature's bucket is the CRC-32
of its UTF-8 bytes modulo ``buckets``.

The corpus holds S features, s of them in a bucket; the target T and t. The gain
of a bucket is floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))), a
document's weight the floored mean of its features' gains. Gumbel noise made from
a hash of the id is added and the highest scores are drawn without replacement:
floor(``percent`` * N / 100) of the N documents with ``min_words`` words or more.

At scale:

* texts are tokenised once: the bucket numbers of every document are stored (two
  bytes a feature for up to 65,536 buckets) and both the histogram and the weights
  are made from them;
* histograms and gains have one cell per bucket, which is what is broadcast;
* the draw is no sort of the corpus. Scores are whole thousandths, so the counts
  by score are a small table (weights lie within +-53,000, noise within 26,010);
  its running total from the top gives every score the ranks before it. Only
  rows at or above the last drawn score are numbered, within their score, and
  ids spread by their hash: no score holds more than about a 2,700th of the rows
  of one weight, rows that repeat an id being counted as one.

Defined results: null and word-free texts have no features and weight 0 and are
never drawn (``min_words`` is 1 at least); a null id is hashed as empty text, so
it has a score, and ranks before other ids of its score; rows that repeat an id
and a text are rows of their own, with the ranks of their score in any order;
texts that share an id and a score rank by their number of features; empty documents
give an empty result, an empty target has T = 0; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import slices, stored, table

# The word rule, in the notation of the tokenizers library.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RUNS = 1                  # longest run of words that is a feature
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
CACHE = 200_000           # words whose bucket a task remembers
EXPAND = 100_000          # repeated rows that one row is turned into at a time


class Windows:
    """Buckets of a text's word runs."""

    def __init__(self, runs: int, buckets: int):
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(WORDS), behavior="removed", invert=True)
        self.runs, self.buckets = runs, buckets
        self.kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
        self.known: dict[str, int] = {}

    def words(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        return self.split.pre_tokenize_str(text.encode("utf-8", "replace").lower().decode("utf-8"))

    def _single(self, words: list[tuple[str, tuple[int, int]]]) -> list[int]:
        known, out = self.known, []
        for w, _ in words:
            b = known.get(w)
            if b is None:
                if len(known) >= CACHE:
                    known.clear()
                b = known[w] = zlib.crc32(w.encode()) % self.buckets
            out.append(b)
        return out

    def of(self, text: str | None) -> tuple[int, np.ndarray]:
        """(number of words, bucket of every feature)."""
        words = [] if text is None else self.words(text)
        out = self._single(words) if self.runs >= 1 else []
        if self.runs > 1 and words:
            size = np.array([len(w.encode()) for w, _ in words])
            end = np.cumsum(size + 1) - 1                   # offsets in the words joined by single spaces
            start = end - size
            line = memoryview(" ".join(w for w, _ in words).encode())
            for n in range(2, self.runs + 1):
                for a, b in zip(start[:len(words) - n + 1].tolist(), end[n - 1:].tolist()):
                    out.append(zlib.crc32(line[a:b]) % self.buckets)
        return len(words), np.array(out, dtype=self.kind)


def bucket_rows(docs: DataFrame, *, runs: int = RUNS, buckets: int = BUCKETS, key: str | None = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_features, buckets as little-endian bytes) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(runs, buckets)
        for b in batches:
            for lo, hi in slices(b, "text"):
                s = b.slice(lo, hi - lo)
                found = [windows.of(t) for t in s.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [s.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array([len(x) for _, x in found], pa.int64()),
                     pa.array([x.tobytes() for _, x in found], pa.binary())], names=["doc_id", "n_words", "n_features", "buckets"])

    doc_id = F.lit(None).cast("long") if key is None else F.col(f"`{key}`").cast("long")
    src = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_words long, n_features long, buckets binary")


def _kind(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def histogram(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket: one vector a task, added up; ``buckets`` numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for raw in b.column("buckets").to_pylist():
                total += np.bincount(np.frombuffer(raw, dtype=_kind(buckets)), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    found = rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) per bucket."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the gains of each document added up."""
    gain_of, kind = rows.sparkSession.sparkContext.broadcast(gain), _kind(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = gain_of.value
        for b in batches:
            at = [np.frombuffer(raw, dtype=kind) for raw in b.column("buckets").to_pylist()]
            weight = [int(g[x].sum()) // len(x) if len(x) else 0 for x in at]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_words"), b.column("n_features"), pa.array(weight, pa.int64())],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def with_score(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with score = weight + Gumbel noise in thousandths, from a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return rows.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))))


def drawn(scored: DataFrame, *, min_words: int, percent: int) -> DataFrame:
    """``scored`` (a stored table) with rank, null for rows that are not drawn."""
    able = F.col("n_words") >= max(1, min_words)
    per_score = scored.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    down = W.orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, -1)     # one row per whole score
    totals = per_score.select("score", F.coalesce(F.sum("n").over(down), F.lit(0)).alias("above"),
                              F.floor(F.sum("n").over(W.partitionBy()) * percent / 100).cast("long").alias("take"))
    bases = stored(totals.filter("above < take"), "importance-bases")
    last = F.coalesce(bases.agg(F.min("score")).scalar(), F.lit((1 << 63) - 1))
    near = able & (F.col("score") >= last)
    same = ["score", "doc_id", "weight", "n_words", "n_features"]
    rows = scored.filter(near).groupBy(*same).agg(F.count(F.lit(1)).alias("n")).join(bases, "score")
    order = W.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_first(), F.col("n_features"), F.col("n_words"))
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("first", F.col("above") + F.sum("n").over(upto) - F.col("n") + 1)
    # a row that stands for many is turned back into them a bounded part at a time
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(EXPAND).cast("long")))
    each = F.explode(F.sequence(F.col("from"), F.least(F.col("from") + EXPAND, F.col("n")) - 1))
    ranked = rows.withColumn("from", part).withColumn("k", each).withColumn("r", F.col("first") + F.col("k"))
    ranked = ranked.select("doc_id", "n_features", "weight", "score", F.when(F.col("r") <= F.col("take"), F.col("r")).alias("rank"))
    rest = scored.filter(~near).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)


def importance_draw(docs: DataFrame, target: DataFrame, *, runs: int = RUNS, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
                    percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs``."""
    rows = stored(bucket_rows(docs, runs=runs, buckets=buckets), "importance-buckets")
    aim = bucket_rows(target, runs=runs, buckets=buckets, key=None)
    gain = gains(histogram(rows, buckets), histogram(aim, buckets))
    scored = stored(with_score(weighed(rows, gain), seed), "importance-scores")
    return drawn(scored, min_words=min_words, percent=percent)


def op13_importance(spark, sf_dir: str) -> DataFrame:
    return importance_draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
