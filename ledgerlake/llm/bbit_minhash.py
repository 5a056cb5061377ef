"""Near duplicates by b-bit MinHash over sets of two-word shingles.

Words are lower-cased (A-Z) runs of anything but ASCII white space; a document's
set holds its distinct two-word shingles (a single word is a shingle by itself).
Documents whose sets have 100 * intersection >= 80 * union are linked, and links
chain to components.

Every set gets ``HASHES`` minima. Groups of ``ROWS`` whole minima hashed together
are its ``BANDS`` band keys; of each minimum only the ``BITS`` low bits are kept,
packed bit plane by bit plane, so that one XOR and OR over the planes and a bit
count give the number of positions that differ. Two positions with different
minima agree by chance in one of 2^BITS cases; with E the share that agrees the
corrected estimate is (E - 2^-b) / (1 - 2^-b). A pair with a common band key goes
on if its sizes allow the similarity and the estimate is within ``SLACK``
standard deviations of it; what goes on is confirmed on the full sets (64-bit
hashes of the shingles). A pair at the very threshold shares no band in 1.2 of
10^7 cases (the share is (1 - 0.8^5)^40), and falls short by 6 deviations in 1 of 10^9.

At scale:

* one text pass keeps 0.5 KB a row; equal sets collapse to one class first, so a
  group of copies costs one class however large it is;
* a band key's members are never paired among themselves. First each is compared
  to the key's smallest class, the best match first; then the links so far name
  components, and only keys whose members lie in several components go on: with
  other, hashed centres for ``STARS`` rounds, at last with every member of another
  component: by a join for keys up to ``BUCKET`` members. For larger keys the
  members outside the main component are compared to all in tiles of ``TILE`` by
  ``TILE``; bit counts and full sets are compared inside the task, which returns
  at most one link per component it joins. So no link between different components
  is left out, nor are the pairs of a family of thousands ever listed;
* the sets themselves are made again from the texts of candidates only, where the
  texts lie; a Bloom filter of fixed size names those rows, so no text is shuffled;
* large classes (over a thousandth of the rows, so fewer than a thousand) name
  their component by broadcast, the others by a join.

Defined results: null, empty and word-free texts have size 0 and are their own
component; a row that repeats id and text is linked to its twin like any copy; a
null doc_id is never a component's id unless it has no other, and then is kept;
all rows with the component's id are kept; empty input gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, table
from .simhash import components

HASHES, ROWS = 200, 5
BANDS = HASHES // ROWS
BITS = 4                  # low bits kept of every minimum
PERCENT = 80
SLACK = 6.0               # standard deviations an estimate may lie below the threshold
STARS = 2                 # rounds with hashed centres before members are compared in full
BUCKET = 64               # members of a band key that a join compares; larger keys go by tiles
TILE = 256                # members of a crowded key on either side of a tile
CACHE = 200_000           # words whose hash a task remembers
FILTER_BITS = 1 << 26     # of the filter that tells rows whose set is wanted: 8 MB at any size
FILTER_PROBES = 2
SEED = 12

_PLANE = -(-HASHES // 64) * 8                        # bytes of one bit plane
_RNG = np.random.default_rng(SEED)
_MUL = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_BAND = _RNG.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def lowest_estimate() -> float:
    """The least estimate that goes on to the full sets."""
    chance, j = 2.0 ** -BITS, PERCENT / 100
    agree = j + (1 - j) * chance
    return j - SLACK * (agree * (1 - agree) / HASHES) ** 0.5 / (1 - chance)


# ---------------------------------------------------------------------- hashing
def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingles:
    """Sorted distinct 64-bit hashes of a text's shingles."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        words = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()   # the word rule's six characters
        if not words:
            return np.empty(0, dtype=np.uint64)
        known = self.known
        new = set(words).difference(known)
        if len(known) + len(new) > CACHE:
            known.clear()
            new = set(words)
        for w in new:
            known[w] = xxhash.xxh64_intdigest(w, SEED)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        with np.errstate(over="ignore"):
            if len(h) == 1:
                return _mix(h ^ np.uint64(0x9E3779B97F4A7C15))
            left, right = h[:-1], h[1:]
            return np.unique(_mix(left * np.uint64(0x9E3779B97F4A7C15) + ((right << np.uint64(31)) | (right >> np.uint64(33)))))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least hash of the set under each of ``HASHES`` permutations of 32 bits."""
    x = shingles.astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(out, (_MUL[:, None] * x[i:i + 2048] + _ADD[:, None]).min(axis=1), out=out)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of whole minima, other bands having other keys."""
    with np.errstate(over="ignore"):
        mixed = (_mix(least.reshape(BANDS, ROWS).astype(np.uint64) * _BAND + _BAND)).sum(axis=1, dtype=np.uint64)
        return _mix(mixed + np.arange(BANDS, dtype=np.uint64) * _BAND[0, 0]).view(np.int64)


def packed(least: np.ndarray) -> bytes:
    """The ``BITS`` low bits of the minima (scrambled first), as bit planes."""
    with np.errstate(over="ignore"):
        low = _mix(least.astype(np.uint64))
    planes = np.zeros((BITS, _PLANE), dtype=np.uint8)
    for j in range(BITS):
        bits = np.packbits(((low >> np.uint64(j)) & np.uint64(1)).astype(np.uint8))
        planes[j, :len(bits)] = bits
    return planes.tobytes()


def signatures(raw: list[bytes]) -> np.ndarray:
    """Packed signatures as (rows, BITS, words) of 64 bits."""
    return np.frombuffer(b"".join(raw), dtype=np.uint64).reshape(len(raw), BITS, _PLANE // 8)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of signatures, by bit counts; broadcasts."""
    differ = np.bitwise_or.reduce(a ^ b, axis=-2)
    agree = 1.0 - np.bitwise_count(differ).sum(axis=-1) / HASHES
    chance = 2.0 ** -BITS
    return (agree - chance) / (1 - chance)


# ------------------------------------------------------------------------- rows
def _text_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, h1, h2, size, sig, keys) of every row: h1, h2 name the
    set, ``text_hash`` the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Shingles()
        for b in batches:
            for lo, hi in slices(b, "text"):
                s = b.slice(lo, hi - lo)
                rows = {"h1": [], "h2": [], "size": [], "sig": [], "keys": []}
                for t in s.column("text").to_pylist():
                    x = sets.of(t)
                    least = minima(x) if len(x) else None
                    raw = x.tobytes()
                    rows["h1"].append(xxhash.xxh64_intdigest(raw, 1) - (1 << 63))
                    rows["h2"].append(xxhash.xxh64_intdigest(raw, 2) - (1 << 63))
                    rows["size"].append(len(x))
                    rows["sig"].append(packed(least) if len(x) else None)
                    rows["keys"].append(band_keys(least) if len(x) else None)
                yield pa.RecordBatch.from_arrays(
                    [s.column("doc_id"), s.column("text_hash"), *[pa.array(rows[c], pa.int64()) for c in ("h1", "h2", "size")],
                     pa.array(rows["sig"], pa.binary()), pa.array(rows["keys"], pa.list_(pa.int64()))],
                    names=["doc_id", "text_hash", "h1", "h2", "size", "sig", "keys"])

    src = _text_rows(docs).withColumn("text_hash", F.xxhash64("text"))
    return src.mapInArrow(run, "doc_id long, text_hash long, h1 long, h2 long, size long, sig binary, keys array<long>")


def set_classes(rows: DataFrame) -> DataFrame:
    """Distinct non-empty sets: id, h1, h2, size, sig, keys, the smallest doc_id, the
    number of rows, and (of_id, of_hash) naming a row that has the set. Stored, which fixes the ids."""
    g = rows.filter("size > 0").groupBy("h1", "h2").agg(
        F.min("size").alias("size"), F.first("sig").alias("sig"), F.first("keys").alias("keys"),
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash")).alias("of"))
    g = g.select("h1", "h2", "size", "sig", "keys", "first_id", "n", F.col("of.doc_id").alias("of_id"), F.col("of.text_hash").alias("of_hash"))
    return stored(g.withColumn("id", F.monotonically_increasing_id()), "minhash-classes")


# ------------------------------------------------------------------ pairs of classes
def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and estimate allow a link, with the estimate. Stored."""
    least = lowest_estimate()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            e = estimates(signatures(b.column("sig_a").to_pylist()), signatures(b.column("sig_b").to_pylist()))
            ok = pa.array(e >= least)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(e)], names=["a", "b", "e"]).filter(ok)

    side = lambda c: classes.select(F.col("id").alias(c), F.col("size").alias(f"size_{c}"), F.col("sig").alias(f"sig_{c}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * PERCENT)
    return stored(sized.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long, e double"), "minhash-near")


def _positions(keys: np.ndarray) -> np.ndarray:
    """The ``FILTER_PROBES`` bits of every 64-bit key in the row filter."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64)
        return np.stack([_mix(x + np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(FILTER_BITS - 1) for k in range(FILTER_PROBES)])


def row_filter(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of the ``key`` column as bytes, ``FILTER_BITS`` bits at any size:
    its bytes are put together by Spark, and at most so many of them reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(_positions(b.column("key").to_numpy()).ravel()).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 3), pa.array(1 << (at & 7))], names=["byte", "bit"])

    found = keys.mapInArrow(run, "byte long, bit long").groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    out[found.column("byte").to_numpy()] = found.column("bits").to_numpy()
    return out


def candidate_sets(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, set) of the classes named by ``ids``: their shingle hashes made from the
    text again, as bytes. Stored.

    The texts are read where they lie: a filter of fixed size tells which rows may be
    wanted, and only their sets are shuffled, to be joined to the ids exactly."""
    wanted = stored(classes.join(ids, "id", "left_semi").select("id", "of_id", "of_hash"), "minhash-wanted")
    bits = docs.sparkSession.sparkContext.broadcast(row_filter(wanted.select(F.xxhash64("of_hash", "of_id").alias("key"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, table_ = Shingles(), bits.value
        for b in batches:
            at = _positions(b.column("key").to_numpy())
            held = (table_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(axis=0)
            b = b.filter(pa.array(held))
            for lo, hi in slices(b, "text"):
                s = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [s.column("doc_id"), s.column("text_hash"), pa.array([sets.of(t).tobytes() for t in s.column("text").to_pylist()], pa.binary())],
                    names=["doc_id", "text_hash", "set"])

    src = _text_rows(docs).withColumn("text_hash", F.xxhash64("text")).withColumn("key", F.xxhash64("text_hash", "doc_id"))
    found = src.mapInArrow(run, "doc_id long, text_hash long, set binary")
    found = found.join(wanted, (F.col("text_hash") == F.col("of_hash")) & F.col("doc_id").eqNullSafe(F.col("of_id")))
    # rows that repeat id and text give the same set: one of each is enough
    return stored(found.select("id", "set").dropDuplicates(["id"]), "minhash-sets")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough by their full sets. Stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("set_a"), b.column("set_b")):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = candidate_sets(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), classes, docs)
    side = lambda c: sets.select(F.col("id").alias(c), F.col("set").alias(f"set_{c}"))
    return stored(pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").select("a", "b", "set_a", "set_b")
                  .mapInArrow(run, "a long, b long"), "minhash-links")


def tile_links(ids: np.ndarray, comps: np.ndarray, sizes: np.ndarray, sig: np.ndarray, sets: list[np.ndarray],
               other: np.ndarray) -> list[tuple[int, int]]:
    """Links between members and the ``other`` ones (a mask) of different components,
    at most one less than the components that meet here: what they connect, all do.

    The bit counts name the pairs that may be linked; one pass over the sets of a
    member's candidates then counts what it has in common with every one of them."""
    root = {int(c): int(c) for c in comps}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    vocabulary, place = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.cumsum([0, *map(len, sets)])
    out, held = [], np.zeros(len(vocabulary), dtype=bool)
    columns = np.flatnonzero(~other)
    for r in np.flatnonzero(other):
        near = columns[(comps[columns] != comps[r]) & (np.minimum(sizes[columns], sizes[r]) * 100 >= np.maximum(sizes[columns], sizes[r]) * PERCENT)]
        near = near[estimates(sig[r][None], sig[near]) >= lowest_estimate()]
        if not len(near):
            continue
        mine = place[start[r]:start[r + 1]]
        held[mine] = True
        for c in near:
            x, y = find(int(comps[r])), find(int(comps[c]))
            if x != y:
                common = int(np.count_nonzero(held[place[start[c]:start[c + 1]]]))
                if 100 * common >= PERCENT * (int(sizes[r]) + int(sizes[c]) - common):
                    out.append((int(ids[r]), int(ids[c])))
                    root[max(x, y)] = min(x, y)
        held[mine] = False
    return out


def _tile(key: tuple, rows: pa.Table) -> pa.Table:
    col = {c: rows.column(c).to_numpy() for c in ("id", "comp", "size")}
    other = rows.column("other").combine_chunks().to_numpy(zero_copy_only=False)
    found = []
    if other.any() and not other.all():
        sets = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in rows.column("set")]
        found = tile_links(col["id"], col["comp"], col["size"], signatures(rows.column("sig").to_pylist()), sets, other)
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": pairs.min(axis=1, initial=np.iinfo(np.int64).max), "b": pairs.max(axis=1, initial=0)})


def crowd_links(crowd: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between components that meet in crowded keys, ``crowd`` being (key, id, _id).

    A key's main component is the one most of its members are in. All members of
    keys with the same main component are put together, each once, and those of
    other components are compared to all of them, in tiles. Stored."""
    counted = crowd.groupBy("key", "_id").agg(F.count(F.lit(1)).alias("m"))
    main = counted.groupBy("key").agg(F.max_by("_id", F.struct("m", "_id")).alias("main"))
    pool = stored(crowd.join(main, "key").select("main", "id", F.col("_id").alias("comp")).distinct(), "minhash-pool")
    size = pool.groupBy("main").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("comp") != F.col("main")).cast("long")).alias("apart"))
    mine = lambda tiles: F.pmod(F.xxhash64("id"), tiles)
    tiles_n, tiles_r = (F.ceil(F.col(c) / TILE).cast("long") for c in ("n", "apart"))
    every = lambda tiles: F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1))
    sized = pool.join(size.filter("apart > 0"), "main")
    # side of all members: one tile of its own, with every tile of the others; and the other way round
    columns = sized.withColumn("j", mine(tiles_n)).withColumn("i", every(tiles_r)).withColumn("other", F.lit(False))
    rows = sized.filter("comp <> main").withColumn("i", mine(tiles_r)).withColumn("j", every(tiles_n)).withColumn("other", F.lit(True))
    cells = columns.select("main", "i", "j", "id", "comp", "other").unionByName(rows.select("main", "i", "j", "id", "comp", "other"))
    sets = candidate_sets(pool.select("id").distinct(), classes, docs)
    full = cells.join(classes.select("id", "size", "sig"), "id").join(sets, "id")
    return stored(full.groupBy("main", "i", "j").applyInArrow(_tile, "a long, b long").distinct(), "minhash-crowd")


def class_links(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, root) of every class that is linked to another."""
    keys = classes.select("id", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("rep")).filter("n > 1")
    members = stored(keys.join(shared, "key"), "minhash-buckets")
    tested = estimated(members.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b")).distinct(), classes)
    best = tested.groupBy("b").agg(F.max_by("a", F.struct("e", F.negate("a"))).alias("a")).select("a", "b")
    links = confirmed(best, classes, docs)
    roots = components(links)

    def named(df: DataFrame, column: str) -> DataFrame:
        r = roots.select(F.col("node").alias(column), F.col("root").alias(f"_{column}"))
        return df.join(r, column, "left").withColumn(f"_{column}", F.coalesce(f"_{column}", column))

    def grow(pairs: DataFrame) -> None:
        nonlocal links, roots
        pairs = stored(pairs, "minhash-apart")
        if pairs.isEmpty():
            return
        links = links.unionByName(confirmed(pairs, classes, docs))
        roots = components(links)

    def apart(pairs: DataFrame) -> DataFrame:
        return named(named(pairs.select("a", "b"), "a"), "b").filter("_a <> _b").select("a", "b")

    grow(apart(tested.join(best, ["a", "b"], "left_anti")))
    done = stored(tested.select("a", "b"), "minhash-done")
    for turn in range(STARS + 1):
        m = named(members.select("key", "id", "n"), "id")
        mixed = (m.groupBy("key").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"),
                                      F.min_by(F.struct("id", "_id"), F.xxhash64("id", F.lit(turn))).alias("c"))
                 .filter("lo <> hi"))
        m = stored(m.join(mixed.select("key", F.col("c.id").alias("centre"), F.col("c._id").alias("centre_root")), "key"), "minhash-mixed")
        if m.isEmpty():
            break
        if turn < STARS:
            far = m.filter("_id <> centre_root").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
        else:
            few = m.filter(F.col("n") <= BUCKET).select("key", "id", "_id")
            other = few.select("key", F.col("id").alias("b"), F.col("_id").alias("_b"))
            far = few.join(other, "key").filter("id < b and _id <> _b").select(F.col("id").alias("a"), "b")
        near = estimated(far.distinct().join(done, ["a", "b"], "left_anti"), classes)
        done = done.unionByName(near.select("a", "b"))
        grow(near.select("a", "b"))
        if turn == STARS:
            crowd = named(m.filter(F.col("n") > BUCKET).select("key", "id"), "id")
            more = crowd_links(crowd, classes, docs)
            if not more.isEmpty():
                links = links.unionByName(more)
                roots = components(links)
    return roots


# --------------------------------------------------------------------- documents
def near_duplicate_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    rows = stored(signed(docs), "minhash-rows")
    classes = set_classes(rows)
    roots = class_links(classes, docs)
    named = classes.join(roots, classes.id == roots.node, "left").select("h1", "h2", "n", "first_id", F.coalesce("root", "id").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stored(named.join(least, "root").select("h1", "h2", "n", "component_id"), "minhash-named")
    slim = rows.select("doc_id", "h1", "h2", "size")
    total = rows.count()
    # a set with over a thousandth of all rows: there are fewer than a thousand of them
    hot = F.broadcast(named.filter(F.col("n") * 1000 > total).select("h1", "h2", F.col("component_id").alias("hot_id"), F.lit(True).alias("is_hot")))
    marked = slim.filter("size > 0").join(hot, ["h1", "h2"], "left")
    cold = (marked.filter(F.col("is_hot").isNull()).select("doc_id", "h1", "h2", "size")
            .join(named.filter(F.col("n") * 1000 <= total).drop("n"), ["h1", "h2"]))
    parts = [cold, marked.filter("is_hot").withColumnRenamed("hot_id", "component_id"),
             slim.filter("size = 0").withColumn("component_id", F.col("doc_id"))]
    out = [p.select("doc_id", F.col("size").alias("n_shingles"), "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")) for p in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


def op12_bbit_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_sets(table(spark, sf_dir, "documents"))
