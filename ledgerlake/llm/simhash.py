"""SimHash near-duplicates with Golay-code fuzzy hashing.

Fingerprint: every shingle of three words is hashed with XXH64; a bit of the
64-bit fingerprint is 1 if it is set in over half of the hashes. Fingerprints
that differ in two bits or fewer are linked; a component is what links reach.

Candidates by the binary Golay code [23, 12, 7]. It is perfect: every 23-bit
word lies within three bits of exactly one codeword. A word lists the
codewords within four bits of it (one, or six if its own is three bits away);
two words that differ in two bits or fewer then always list a common one
(a word at distance three and its neighbour meet in the one weight-seven
block through the three wrong bits and the first new one). The fingerprint is
cut into three segments of 22, 21 and 21 bits, each padded to 23. With two
wrong bits or fewer, pigeonhole leaves a segment j without an error such that
the segment after it has at most one. So the keys (j, segment j as it is, a
listed codeword of the next segment) - about 16 per fingerprint, each of 33 or
34 bits - give every linked pair a common key. Pairs of a key are verified by
counting differing bits.

At scale:

* one text pass; copies collapse to distinct fingerprints before any key is
  made, so a group of exact copies costs one fingerprint;
* 34-bit keys keep buckets at about ten for 10^10 distinct fingerprints;
* a key shared by over ``BUCKET`` fingerprints (a family of near copies) is
  never paired: its members are linked exactly through midpoints instead. Two
  words differ in two bits or fewer if and only if some word is within one
  bit of both, so each member lists itself and its 64 one-bit neighbours, and
  all that list the same word are linked to the smallest of them: 65 rows a
  member, no pairs, no lost link;
* components come from alternating large-star and small-star rounds on the
  links between distinct fingerprints; rounds write their links to the shared
  folder, and nothing of the corpus is collected.

Defined results: null and word-free texts have fingerprint zero and are linked
like others; fewer than three words make one shingle; repeated rows are
separate rows of one component; a null doc_id never becomes a component id
unless its component has no other; empty input gives an empty result; extra
columns are ignored (``deduplicate`` passes them through).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_hash, slices, stored, table

SHINGLE = 3
MAX_BITS = 2              # differing bits that still link; keys and midpoints are made for two
SEED = 42
BUCKET = 64               # a key with more fingerprints is linked through midpoints
# Generator polynomial of the binary Golay code; widths of the three segments.
GENERATOR = 0b101011100011
WIDTHS = (22, 21, 21)


# ------------------------------------------------------------------ fingerprints
def fingerprints(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each text as uint64."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i, t in enumerate(texts):
        words = b"" if t is None else t.encode("utf-8", "surrogatepass").lower()
        words = words.split()                       # ASCII white space, the word rule's six characters
        if not words:
            continue
        n = min(shingle, len(words))
        line = b" ".join(words)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        end = np.cumsum(size) - 1
        start = end - size + 1
        hashes += [digest(line[a:b], SEED) for a, b in zip(start[:len(words) - n + 1].tolist(), end[n - 1:].tolist())]
        counts[i] = len(words) - n + 1
    out = np.zeros(len(texts), dtype=np.uint64)
    if hashes:
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        full = np.flatnonzero(counts)
        first = np.cumsum(counts[full]) - counts[full]
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        packed = np.packbits(ones * 2 > counts[full][:, None], axis=1)
        out[full] = packed.view(">u8").ravel().astype(np.uint64)
    return out


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_hash, fp) for every row, fp as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b, "text"):
                s = b.slice(lo, hi - lo)
                fp = fingerprints(s.column("text").to_pylist(), shingle)
                yield pa.RecordBatch.from_arrays([s.column("doc_id"), s.column("row_hash"), pa.array(fp.view(np.int64))],
                                                 names=["doc_id", "row_hash", "fp"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash(["text"]).alias("row_hash"),
                      F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, row_hash long, fp long")


# -------------------------------------------------------------------- Golay keys
def _syndrome(word: int) -> int:
    for i in range(22, 10, -1):
        if word >> i & 1:
            word ^= GENERATOR << (i - 11)
    return word


def _decoder() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndrome of each bit; per syndrome the error patterns of up to four bits
    (one of at most three bits, and five of four bits where that one has three)."""
    bit = np.array([_syndrome(1 << i) for i in range(23)], dtype=np.int64)
    patterns = np.zeros((2048, 6), dtype=np.int64)
    count = np.zeros(2048, dtype=np.int64)
    for weight in range(5):
        for where in combinations(range(23), weight):
            s = 0
            for i in where:
                s ^= int(bit[i])
            if weight < 4 or patterns[s, 0].item().bit_count() == 3:
                patterns[s, count[s]] = sum(1 << i for i in where)
                count[s] += 1
    return bit, patterns, count


_BIT, _PATTERNS, _COUNT = _decoder()


def codeword_indices(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) of the codewords within four bits of each 23-bit word. The
    code is systematic: the upper twelve bits number the codeword."""
    syndrome = np.zeros(len(segment), dtype=np.int64)
    for i in range(23):
        syndrome ^= np.where(segment >> i & 1, _BIT[i], 0)
    count = _COUNT[syndrome]
    row = np.repeat(np.arange(len(segment)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, (segment[row] ^ _PATTERNS[syndrome[row], nth]) >> 11


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for uint64 fingerprints; rows with a common key may be linked."""
    shift = np.cumsum((0, *WIDTHS[:-1]))
    part = [((fp >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in zip(shift, WIDTHS)]
    rows, keys = [], []
    for j in range(3):
        row, index = codeword_indices(part[(j + 1) % 3])
        rows.append(row)
        keys.append((np.int64(j) << 34) | (part[j][row] << 12) | index)
    return np.concatenate(rows), np.concatenate(keys)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column("fp").to_numpy(zero_copy_only=False)
        row, key = golay_keys(fp.view(np.uint64))
        for i in range(0, len(row), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(key[i:i + 100_000]), pa.array(fp[row[i:i + 100_000]])],
                                             names=["key", "fp"])


# ------------------------------------------------------------------------- links
def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``prints.fp``: all of two bits
    or fewer within buckets up to ``bucket``, and through midpoints a set that
    connects the same fingerprints in larger ones."""
    keys = stored(prints.select("fp").mapInArrow(_key_rows, "key long, fp long"), "golay-keys")
    size = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sized = stored(keys.join(size, "key"), "golay-buckets")
    small = sized.filter(F.col("n") <= bucket).select("key", "fp")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    paired = (small.withColumnRenamed("fp", "a").join(small.withColumnRenamed("fp", "b"), "key")
              .filter((F.col("a") < F.col("b")) & near).select("a", "b").distinct())
    crowded = sized.filter(F.col("n") > bucket).select("fp").distinct()
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)]
    mids = crowded.select("fp", F.explode(F.array(*flips)).alias("mid"))
    least = mids.groupBy("mid").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    starred = (mids.join(least.select("mid", "a"), "mid").filter("fp <> a")
               .select("a", F.col("fp").alias("b")).distinct())
    return paired.unionByName(starred).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of every linked node's component.

    Alternating large-star and small-star: both only re-attach links to a
    smaller end, so their count never grows, and the number of rounds grows
    with the logarithm of the longest chain. Ends when a round changes nothing.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links")
    seen = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").filter("u <> v").distinct())
        e = stored(small, "links")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
    raise RuntimeError("the component rounds did not settle")


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """doc_id, row_hash, fp, component_id for every row of ``docs``."""
    rows = stored(with_fingerprint(docs, shingle), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "distinct")
    roots = components(links(prints, bucket))
    named = prints.join(roots, prints.fp == roots.node, "left").select("fp", "n", "first_id", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stored(named.join(least, "root").select("fp", "n", "component_id"), "named")
    # A fingerprint with over a thousandth of all rows: there are fewer than a
    # thousand of them, so their names are broadcast; the others join by key.
    total = rows.count()
    hot = F.broadcast(named.filter(F.col("n") * 1000 > total).select("fp", F.col("component_id").alias("hot_id"), F.lit(True).alias("is_hot")))
    marked = rows.join(hot, "fp", "left")
    cold = marked.filter(F.col("is_hot").isNull()).select("doc_id", "row_hash", "fp").join(named.filter(F.col("n") * 1000 <= total).select("fp", "component_id"), "fp")
    return (marked.filter("is_hot").select("doc_id", "row_hash", "fp", F.col("hot_id").alias("component_id"))
            .unionByName(cold.select("doc_id", "row_hash", "fp", "component_id")))


def deduplicate(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` with one document of each component: the one whose doc_id names
    it. Where several rows have that id, the least text hash stays, and any one of
    the rows that repeat id and text; a component without any id keeps one row too."""
    named = near_duplicates(docs, **kw).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    same = named.groupBy("doc_id", "row_hash").agg(F.min("fp").alias("fp"), F.count(F.lit(1)).alias("n"))
    # without an id the fingerprint stands for the component
    place = F.when(F.col("doc_id").isNull(), F.col("fp"))
    keep = (same.groupBy("doc_id", place.alias("p")).agg(F.min(F.struct("row_hash", "n")).alias("k"))
            .select(F.col("doc_id").alias("_keep_id"), F.col("k.row_hash").alias("_keep_hash"), F.col("k.n").alias("_n")))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        F.col("doc_id").cast("long").alias("_id"), row_hash(["text"]).alias("_hash"))
    kept = keyed.join(keep, (F.col("_hash") == F.col("_keep_hash")) & F.col("_id").eqNullSafe(F.col("_keep_id")))
    once = kept.filter("_n = 1").select("_row")
    repeated = kept.filter("_n > 1").dropDuplicates(["_id", "_hash"]).select("_row")
    return once.unionByName(repeated).select("_row.*")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    d = near_duplicates(table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return d.select("doc_id", hexed.alias("fingerprint"), "component_id")
