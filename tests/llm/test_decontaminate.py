"""Winnowing against a window-by-window search."""
import hashlib
import random
import re

import pytest

from ledgerlake.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return [] if t is None else WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, it in items:
            q = words(it)
            n = min(10, len(q))
            wins = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)} if q else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit.update(range(i, i + n))
                    ids.add(item_id)
        text_ids = ",".join(sorted(str(x) for x in ids))
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(text_ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, tmp_path, docs, items):
    d = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_words", "'x' as rid") \
        .write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 as h") \
        .write.parquet(f"{d}/benchmark.parquet")
    return sorted([tuple(r) for r in D.op7_decontaminate(spark, d).collect()], key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, tmp_path, seed):
    rnd = random.Random(seed)
    voc = ["a", "B", "ça", "d1", "É", "ff", "g"]
    text = lambda n: " ".join(rnd.choice(voc) + rnd.choice(["", ",", "\n", "--"]) for _ in range(n))
    items = [(i, text(rnd.choice([0, 1, 3, 6, 9, 10, 11, 25, 60]))) for i in range(12)] + [(3, None), (99, "")]
    items += [items[9], (77, items[9][1])]
    docs = []
    for i in range(60):
        t = text(rnd.randrange(0, 40))
        src = rnd.choice(items)[1] or ""
        sw = src.split(" ")
        a = rnd.randrange(0, max(1, len(sw)))
        docs.append((i, t + " " + " ".join(sw[a:a + rnd.randrange(5, 30)]).upper() + " " + text(5)))
    docs += [(None, docs[0][1]), (5, docs[5][1]), (61, None), (62, ""), (63, " .,; "), (64, text(5) * 3000)]
    assert run(spark, tmp_path, docs, items) == brute(docs, items)


def test_empty_tables(spark, tmp_path):
    assert run(spark, tmp_path / "a", [], [(1, "a b c")]) == []
    assert [r[2] for r in run(spark, tmp_path / "b", [(1, "a b c d")], [])] == [0]


def test_decontaminate_keeps_clean_rows(spark):
    long = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, long, "x"), (1, "clean text", "y"), (None, None, None), (2, "other", "z")],
                                 "doc_id long, text string, row_hash string")
    bench = spark.createDataFrame([(7, " ".join(f"w{i}" for i in range(5, 17)))], "item_id long, text string")
    got = D.decontaminate(docs, bench)
    assert got.columns == docs.columns
    assert sorted((r.row_hash for r in got.collect()), key=str) == [None, "y", "z"]


def test_every_shared_span_keeps_a_fingerprint():
    rnd = random.Random(3)
    for _ in range(50):
        shared = " ".join(str(rnd.randrange(50)) for _ in range(10))
        a = " ".join(str(rnd.randrange(50)) for _ in range(rnd.randrange(20))) + " " + shared
        b = shared + " " + " ".join(str(rnd.randrange(50)) for _ in range(rnd.randrange(20)))
        prints = []
        for t in (a, b):
            _, _, _, h, off = D.words_of([t])
            prints.append(set(D.winnow(h, off)[1].tolist()))
        assert prints[0] & prints[1]


def test_a_phrase_of_many_items_makes_no_pairs(spark):
    """Nine words that all documents and items share are no window; ten that many items share are met once."""
    nine, ten = " ".join(f"p{i}" for i in range(9)), " ".join(f"q{i}" for i in range(10))
    docs = spark.createDataFrame([(i, f"d{i} {nine} e{i} " + (f"f{i} {ten} g{i}" if i % 50 == 0 else "")) for i in range(500)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"i{i} {nine} j{i} {'x ' * 12}" + (ten if i % 2 else "")) for i in range(300)], "item_id long, text string")
    base, hits, known = D.hit_windows(docs, items)
    assert hits.count() == 10 and base.count() == 500
    got = D.contamination(docs, items).filter("contaminated").collect()
    assert sorted((r.doc_id, r.n_hit, len(r["items"])) for r in got) == [(i, 10, 150) for i in range(0, 500, 50)]
