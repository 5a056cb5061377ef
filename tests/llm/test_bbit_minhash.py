"""b-bit MinHash components against exact Jaccard similarity of all pairs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import bbit_minhash as B

SCHEMA = "doc_id long, text string, lang string, size long, id long, keys string"


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset((w,) for w in words)


def brute(rows):
    """{(doc_id, n_shingles, component_id, kept): count}, from all pairs of rows."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        i = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * i >= 80 * (len(sets[a]) + len(sets[b]) - i):
            root[find(a)] = find(b)
    ids = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            ids[find(k)] = min(r[0], ids.get(find(k), r[0]))
    out = []
    for k, r in enumerate(rows):
        c = ids.get(find(k)) if sets[k] else r[0]
        out.append((r[0], len(sets[k]), c, r[0] == c))
    return sorted(out, key=str)


def words(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def near(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
    return w


def corpus(seed=5):
    rng = random.Random(seed)
    texts = []
    for _ in range(25):                                       # families around the threshold
        base = words(rng, rng.randrange(6, 120))
        texts += [" ".join(near(rng, base, rng.randrange(0, 1 + len(base) // 12))) for _ in range(rng.randrange(1, 9))]
    chain = words(rng, 100)                                   # a chain whose ends are not similar
    for k in range(0, 60, 4):
        texts.append(" ".join(chain[:k] + [f"c{j}" for j in range(k)] + chain[k:]))
        texts.append(" ".join(f"y{j}" if j < k else w for j, w in enumerate(chain)))
    texts += [None, "", " \t\n", "one", "ONE ", "one two", "One\tTwo", "one two one", "été É漢", "ÉTÉ é漢", "w1 w2 w3 w4 w5", "w1 w2 w3 w4 w5 w6"]
    texts += ["long " + " ".join(words(rng, 30_000))]
    rows = [(k + 1, t, None, 1, 2, "k") for k, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + rows[:4] + [(None, rows[9][1], None, None, None, None), (None, "unique words without any id", None, None, None, None)]


def result(df):
    return sorted(map(tuple, B.near_duplicate_sets(df).collect()), key=str)


@pytest.mark.parametrize("stars,bucket,tile", [(2, 64, 512), (0, 2, 3)])
def test_against_all_pairs(spark, monkeypatch, stars, bucket, tile):
    """The second run leaves all to the joins and tiles of the last step."""
    monkeypatch.setattr(B, "STARS", stars)
    monkeypatch.setattr(B, "BUCKET", bucket)
    monkeypatch.setattr(B, "TILE", tile)
    rows = corpus()
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_empty_and_word_free_tables(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    rows = [(1, None, None, None, None, None), (1, "", None, None, None, None), (None, " ", None, None, None, None)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.0, 0.2, 0.5, 0.8, 0.95):
        for _ in range(30):
            common = rng.integers(0, 1 << 63, int(1000 * share), dtype=np.uint64)
            a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 1000 - len(common), dtype=np.uint64)])) for _ in "ab")
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            e = B.estimates(B.signatures([B.packed(B.minima(a))]), B.signatures([B.packed(B.minima(b))]))[0]
            errors.append(e - j)
    assert abs(np.mean(errors)) < 0.01 and max(map(abs, errors)) < 0.15
    assert 0.55 < B.lowest_estimate() < 0.7


def test_shingle_hashes_tell_order_and_pairs_apart():
    s = B.Shingles()
    texts = ["a b", "b a", "a", "b", "ab", "a a", "b b", "a b c"]
    assert len({s.of(t).tobytes() for t in texts}) == len(texts)
    assert s.of("A b\x0bA\x0cb").tobytes() == s.of("a b a").tobytes() or len(s.of("a b a b")) == 2
    assert len(s.of("a b a b a b")) == 2


def test_row_filter_holds_every_wanted_row(spark):
    keys = spark.range(5000).select((F.col("id") * 7919 - 10_000_000).alias("key"))
    bits = B.row_filter(keys)
    at = B._positions(np.arange(5000, dtype=np.int64) * 7919 - 10_000_000)
    hit = lambda p: (bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).all(axis=0)
    assert hit(at).all()
    assert hit(B._positions(np.arange(50_000, dtype=np.int64) * 7919 + 5)).mean() < 0.01
