"""SimHash links against all pairs, and the Golay keys against the code's geometry."""
import random

import numpy as np
import pytest
import xxhash

from ledgerlake.llm import simhash as S


def brute_print(t):
    w = [] if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t).encode().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    """{index: smallest reachable id} over (id, fp) rows."""
    left, out = set(range(len(prints))), {}
    while left:
        comp, todo = set(), [left.pop()]
        while todo:
            i = todo.pop()
            comp.add(i)
            near = {j for j in left if (prints[i][1] ^ prints[j][1]).bit_count() <= 2}
            left -= near
            todo += near
        ids = [prints[i][0] for i in comp if prints[i][0] is not None]
        out |= {i: min(ids, default=None) for i in comp}
    return out


def test_fingerprints():
    texts = [None, "", " \n\t", "One", "a b", "A b C d", "é É ß a b", "x " * 999, "p q r s t u v w"]
    assert S.fingerprints(texts).tolist() == [brute_print(t) for t in texts]


def test_pairs_within_two_bits_share_a_key():
    rnd = random.Random(5)
    a = np.array([rnd.getrandbits(64) for _ in range(4000)], dtype=np.uint64)
    flip = np.array([sum({1 << rnd.randrange(64) for _ in range(rnd.choice([0, 1, 2]))}) for _ in a], dtype=np.uint64)
    ra, ka = S.golay_keys(a)
    rb, kb = S.golay_keys(a ^ flip)
    pairs = set(zip(ra.tolist(), ka.tolist())) & set(zip(rb.tolist(), kb.tolist()))
    assert {r for r, _ in pairs} == set(range(len(a)))
    assert 12 < len(ra) / len(a) < 18


@pytest.mark.parametrize("bucket", [64, 2])
def test_components_match_all_pairs(spark, bucket):
    rnd = random.Random(bucket)
    prints = []
    for _ in range(12):                      # chains of single and double flips around random centres
        x = rnd.getrandbits(64)
        for _ in range(rnd.randrange(1, 25)):
            prints.append(x)
            x ^= 1 << rnd.randrange(64)
            if rnd.random() < .5:
                x ^= 1 << rnd.randrange(64)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r.node: r.root for r in S.components(S.links(df, bucket=bucket)).collect()}
    want = brute_components(list(zip(signed, prints)))
    assert {p: roots.get(p, p) for p in signed} == {p: want[i] for i, p in enumerate(signed)}


def rows():
    rnd = random.Random(9)
    base = " ".join(rnd.choice("abcdefghij") + str(rnd.randrange(30)) for _ in range(400))
    return [(4, base), (9, base + " x"), (2, base.upper()), (7, base.replace("a1", "a2", 1)), (None, base), (30, "solo text here"),
            (30, "solo text here"), (31, None), (32, ""), (33, "  \n"), (None, "nobody owns this"), (40, "one"), (41, "two words"),
            (50, base * 200), (51, base * 200)]


def test_query_on_nulls_repeats_and_long_texts(spark, tmp_path):
    spark.createDataFrame([(*r, 1, "z") for r in rows()], "doc_id long, text string, fp int, component_id string") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted([tuple(r) for r in S.op5_simhash(spark, str(tmp_path)).collect()], key=str)
    prints = [(i, brute_print(t)) for i, t in rows()]
    comp = brute_components(prints)
    assert got == sorted([(i, f"{p:016x}", comp[k]) for k, (i, p) in enumerate(prints)], key=str)


def test_deduplicate_keeps_one_of_each(spark):
    docs = spark.createDataFrame([(*r, "z") for r in rows()], "doc_id long, text string, fp string")
    kept = S.deduplicate(docs)
    assert kept.columns == docs.columns
    prints = [(i, brute_print(t)) for i, t in rows()]
    comp = brute_components(prints)
    want = sorted([c for c in set(comp.values())], key=str)
    assert sorted([r.doc_id for r in kept.collect()], key=str) == want


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert S.op5_simhash(spark, str(tmp_path)).collect() == []
