"""Benchmark decontamination by winnowing.

Words are hashed, ``K`` consecutive words make a k-gram, and of every sliding
window of ``SPAN - K + 1`` k-grams the one with the least hash is kept
(rightmost on ties). The choice depends on the window alone, so any span of
``SPAN`` words shared by a document and a benchmark item keeps the same k-gram
on both sides: no shared span of that length can be missed. Fingerprints that
both sides have are extended to every span of ``SPAN`` words around their k-gram,
and the documents' spans are joined to the benchmark's distinct ones; equal spans
are hits, and overlapping hits make longer ones. Items shorter than ``SPAN`` words have no full window: all their words make
one n-gram, looked up among the documents' n-grams of that length.

At scale: one pass over the document texts (numpy over the bytes of many
documents at once) writes per document the word count and the few
fingerprints that a fixed-size bitmap of the benchmark's hashes lets through;
the bitmap's size is a parameter, so what is broadcast doesn't grow with the
data, and it never loses a match (the join decides). Only those fingerprints
are shuffled, each with the words around it, so that extending needs no second
read of the text. A phrase that many items share is one k-gram and few distinct
spans: a document meets each span once, in salted parts, and items are looked up
by span at the end, so common phrases don't make documents x items pairs.

Defined results: a null or word-free text has no words and no hits; a
word-free or null item is in no document; repeated documents each get their
own row; repeated item ids count once; an empty benchmark flags nothing; an
empty documents table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import salted_join
from .common import drop_rows, row_hash, slices, stored

SPAN = 10                 # words of the shortest shared span that must be found
K = 5                     # words of a k-gram; the window holds SPAN - K + 1 of them
SALTS = 16                # parts in which a span that many documents hold meets the benchmark's
BITMAP_BITS = 24          # log2 of the bits of the benchmark bitmap (2 MB)

# Odd multipliers of the rolling byte hash and the 64-bit finalizer.
_P = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


_POWERS = np.ones(1, dtype=np.uint64)
_INVERSE = pow(int(_P), -1, 1 << 64)
_INV_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^0..P^n and their inverses modulo 2^64, kept and grown in the worker."""
    global _POWERS, _INV_POWERS
    if len(_POWERS) < n:
        size = 1 << (n - 1).bit_length()
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _P)]), dtype=np.uint64)
        _INV_POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, np.uint64(_INVERSE))]),
                                 dtype=np.uint64)
    return _POWERS, _INV_POWERS


def words_of(texts: list[str | None]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, and per word: start, end, hash, and the
    word offsets of the texts (one more than texts)."""
    parts = [b"" if t is None else t.encode("utf-8", "surrogatepass").lower() for t in texts]
    buf = b"\n".join(parts)
    a = np.frombuffer(buf, dtype=np.uint8)
    inside = np.concatenate([[False], _IS_WORD[a], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]
    up, down = _powers(len(a) + 1)
    total = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[:len(a)], dtype=np.uint64, out=total[1:])
    h = _mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    first = np.cumsum([0] + [len(p) + 1 for p in parts])
    return buf, start, end, h, np.searchsorted(start, first)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on (positions over text ends included)."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    m = len(h) - n + 1
    g = np.full(m, np.uint64(n))
    for j in range(n):
        g = _mix(g * _P + h[j:j + m])
    return g


def winnow(h: np.ndarray, offsets: np.ndarray, span: int = SPAN, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Kept k-grams as (word position, hash); ``offsets`` are the texts' word
    offsets, no window crosses them."""
    g, w = grams(h, k), span - k + 1
    if len(h) < span:
        return np.zeros(0, dtype=np.int64), g[:0]
    m = len(h) - span + 1
    best, at = g[:m].copy(), np.zeros(m, dtype=np.int8)
    for j in range(1, w):
        other = g[j:j + m]
        less = other <= best
        best[less] = other[less]
        at[less] = j
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = text[:m] == text[span - 1:span - 1 + m]
    chosen = np.zeros(len(g), dtype=bool)
    chosen[(np.arange(m) + at)[whole]] = True
    pos = np.flatnonzero(chosen)
    return pos, g[pos]


def _bit(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _context(buf: bytes, start, end, lo: int, hi: int) -> str:
    return b" ".join(buf[s:e] for s, e in zip(start[lo:hi].tolist(), end[lo:hi].tolist())).decode("utf-8", "surrogatepass")


def _fingerprints(texts, span: int, k: int, keep=None, short=None):
    """Per text: word count and its fingerprints (hash, position, first word of
    the context, words of the n-gram, context). ``keep`` says which hashes
    pass; ``short`` is the set of n-gram lengths below ``span`` to list (None:
    the text's own length, as for benchmark items)."""
    buf, start, end, h, off = words_of(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(off))
    found: list[list[tuple]] = [[] for _ in texts]
    pos, g = winnow(h, off, span, k)
    if keep is not None and len(pos):
        ok = keep(g)
        pos, g = pos[ok], g[ok]
    room = span - k
    for p, x, t in zip(pos.tolist(), g.astype(np.int64).tolist(), text[pos].tolist()):
        lo, hi = max(p - room, off[t]), min(p + k + room, off[t + 1])
        found[t].append((x, int(p - off[t]), int(lo - off[t]), k, _context(buf, start, end, lo, hi)))
    if short is None:
        for t, (a, b) in enumerate(zip(off[:-1], off[1:])):
            if 0 < b - a < span:
                x = grams(h[a:b], b - a)[0]
                found[t].append((int(x.astype(np.int64)), 0, 0, int(b - a), _context(buf, start, end, a, b)))
    else:
        for n in short:
            g = grams(h, n)
            at = np.flatnonzero((text[:len(g)] == text[n - 1:n - 1 + len(g)]) & keep(g)) if len(g) else []
            for p in at:
                t = text[p]
                found[t].append((int(g[p].astype(np.int64)), int(p - off[t]), int(p - off[t]), n,
                                 _context(buf, start, end, p, p + n)))
    return np.diff(off), found


_PRINTS = "array<struct<h:bigint,pos:int,first:int,n:int,words:string>>"
_PRINT_TYPE = pa.list_(pa.struct([("h", pa.int64()), ("pos", pa.int32()), ("first", pa.int32()),
                                  ("n", pa.int32()), ("words", pa.string())]))


def _print_rows(found) -> pa.Array:
    return pa.array([[{"h": a, "pos": b, "first": c, "n": d, "words": e} for a, b, c, d, e in x] for x in found],
                    type=_PRINT_TYPE)


def benchmark_prints(benchmark: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """(item_id, n_words, h, pos, first, n, words): one row per fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b, "text"):
                s = b.slice(lo, hi - lo)
                n, found = _fingerprints(s.column("text").to_pylist(), span, k)
                yield pa.RecordBatch.from_arrays(
                    [s.column("item_id"), pa.array(n, pa.int64()), _print_rows(found)],
                    names=["item_id", "n_words", "prints"])

    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    return (items.mapInArrow(run, f"item_id long, n_words long, prints {_PRINTS}")
            .select("item_id", "n_words", F.inline("prints")))


def bitmap_of(prints: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bitmap over the top ``bits`` bits of the hashes: at most 2^bits / 64
    rows reach the driver, whatever the benchmark's size."""
    slot = F.shiftrightunsigned(F.col("h"), 64 - bits)
    words = (prints.select(F.shiftright(slot, 6).alias("w"),
                           F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {64 - bits}) & 63 AS INT))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    for r in words.toArrow().to_batches():
        out[r.column("w").to_numpy()] = r.column("b").to_numpy().view(np.uint64)
    return out


def document_prints(docs: DataFrame, bitmap, short: list[int], span: int = SPAN, k: int = K,
                    bits: int = BITMAP_BITS) -> DataFrame:
    """Per document row: row number, doc_id, row hash, n_words, prints that pass the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bitmap.value

        def keep(g: np.ndarray) -> np.ndarray:
            b = _bit(g, bits)
            return (words[b >> 6] >> (b & 63).astype(np.uint64)) & np.uint64(1) == 1

        for b in batches:
            for lo, hi in slices(b, "text"):
                s = b.slice(lo, hi - lo)
                n, found = _fingerprints(s.column("text").to_pylist(), span, k, keep, short)
                yield pa.RecordBatch.from_arrays(
                    [s.column("rid"), s.column("doc_id"), s.column("row_hash"), pa.array(n, pa.int64()),
                     _print_rows(found)], names=["rid", "doc_id", "row_hash", "n_words", "prints"])

    src = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                      row_hash(["text"]).alias("row_hash"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, f"rid long, doc_id long, row_hash long, n_words long, prints {_PRINTS}")


def windows_of(prints: DataFrame, span: int, *carried: str) -> DataFrame:
    """The hits of fingerprints extended to their spans: every run of ``span`` words
    around a kept k-gram (of a shorter n-gram the n-gram itself), as (carried columns,
    a, b, wh, window): word positions, hash and words."""
    w = F.split("words", " ")
    whole = F.array(F.struct(F.col("first").alias("a"), (F.col("first") + F.size("_w")).alias("b"), F.col("words").alias("window")))
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_w") - span)), lambda i: F.struct(
        (F.col("first") + i).alias("a"), (F.col("first") + i + span).alias("b"),
        F.array_join(F.slice("_w", i + 1, F.lit(span)), " ").alias("window")))
    each = prints.withColumn("_w", w).select(*carried, F.explode(F.when(F.size("_w") >= span, runs).otherwise(whole)).alias("x"))
    return each.select(*carried, "x.a", "x.b", F.xxhash64("x.window").alias("wh"), "x.window").distinct()


def hit_windows(docs: DataFrame, benchmark: DataFrame, *, span: int = SPAN, k: int = K,
                bits: int = BITMAP_BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with rid, doc_id, row_hash, n_words; their words [a, b) inside an
    item window, with it; items per window). The documents' windows meet the distinct
    windows of the benchmark, so what many items share is met once."""
    spark = docs.sparkSession
    items = stored(benchmark_prints(benchmark, span, k), "bench-prints")
    short = [r["n_words"] for r in items.filter(F.col("n_words") < span).select("n_words").distinct().collect()]
    bitmap = spark.sparkContext.broadcast(bitmap_of(items, bits))
    prints = stored(document_prints(docs, bitmap, sorted(short), span, k, bits), "doc-prints")
    known = windows_of(items, span, "item_id").groupBy("wh", "window").agg(F.collect_set("item_id").alias("items"))
    mine = windows_of(prints.filter(F.size("prints") > 0).select("rid", F.inline("prints")), span, "rid")
    hits = salted_join(mine, known.select("wh", "window"), ["wh", "window"], "left_semi", ["rid"], SALTS)
    return prints.drop("prints"), stored(hits, "doc-hits"), known


def contamination(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """One row per document row: doc_id, row_hash, n_words, n_hit, items, contaminated."""
    base, hits, known = hit_windows(docs, benchmark, **kw)
    # spans of one document: as many as it has words at most; union of intervals in order
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("a", "b"))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("int").alias("end")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["end"], x["a"]))).cast("long").alias("n"),
            F.greatest(s["end"], x["b"]).alias("end")),
        lambda s: s["n"])
    named = (salted_join(hits.select("rid", "wh", "window").distinct(), known, ["wh", "window"], "inner", ["rid"], SALTS)
             .select("rid", F.explode("items").alias("item_id")).groupBy("rid").agg(F.collect_set("item_id").alias("items")))
    found = hits.groupBy("rid").agg(covered.alias("n_hit")).join(named, "rid", "left")
    return (base.join(found, "rid", "left")
            .select("doc_id", "row_hash", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    bad = contamination(docs, benchmark, **kw).filter("contaminated")
    return drop_rows(docs, bad, {"doc_id": F.col("doc_id").cast("long"), "row_hash": row_hash(["text"])})


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    from .common import table

    c = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return c.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(ids, 256).alias("items_sha256"), "contaminated")
