"""Importance resampling against a version written out document by document."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from ledgerlake.llm import importance as I

SCHEMA = "doc_id long, text string, score string, rank string, buckets string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, runs):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, [" ".join(words[i:i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, runs, buckets, min_words, percent, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for rows, c in ((docs, s), (target, t)):
        for _, text, *_ in rows:
            c.update(map(bucket, features(text, runs)[1]))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out, able = [], []
    for doc_id, text, *_ in docs:
        words, f = features(text, runs)
        weight = math.floor(sum(gain[bucket(x)] for x in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        row = [doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        out.append(row)
        if len(words) >= max(1, min_words):
            able.append(row)
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = k
    return sorted(map(tuple, out), key=str)


def corpus():
    docs = [(i, " ".join(f"w{(i * j) % 17}" for j in range(i % 40)) + (" Target TEXT é漢" * (i % 3)), None, "x", None) for i in range(1, 160)]
    docs += [(200, None, None, None, None), (201, "", "s", None, None), (202, " \n--- 12!", None, None, None), (202, "12", None, None, None),
             (None, "null id " * 15, None, None, None), (None, "null id " * 15, None, None, None), (7, docs[6][1], None, None, None),
             (203, "très LONG tèxt " * 20_000, None, None, None), (204, "a\x00b\x7fc {d} [e] `f` 😀g " * 9, None, None, None)]
    return docs, [(1, "target text é漢 w1 w2", None, None, None), (2, None, None, None, None), (3, "Target w3", None, None, None)]


@pytest.mark.parametrize("runs,buckets,min_words,percent", [(1, 10_000, 20, 10), (3, 70_000, 5, 50), (2, 7, 0, 100)])
def test_against_written_out_version(spark, monkeypatch, runs, buckets, min_words, percent):
    monkeypatch.setattr(I, "EXPAND", 1)
    docs, target = corpus()
    got = I.importance_draw(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(target, SCHEMA), runs=runs, buckets=buckets,
                            min_words=min_words, percent=percent, seed=2024)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, target, runs, buckets, min_words, percent, 2024)


def test_empty_tables(spark):
    docs, target = corpus()
    none = spark.createDataFrame([], SCHEMA)
    assert I.importance_draw(none, spark.createDataFrame(target, SCHEMA)).collect() == []
    got = I.importance_draw(spark.createDataFrame(docs, SCHEMA), none).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, [], 1, 10_000, 20, 10, 2024)


def test_words_and_offsets_of_the_split():
    w = I.Windows(1, 10_000)
    text = "Été ÀB-c 漢字 a\x00b 😀x"
    assert [(t, text.encode().lower().decode()[a:b]) for t, (a, b) in w.words(text)] == [(t, t) for t in features(text, 1)[0]]


def test_a_full_word_memory_changes_nothing(monkeypatch):
    text = "one two three one four two"
    want = I.Windows(1, 10_000).of(text)[1].tolist()
    monkeypatch.setattr(I, "CACHE", 2)
    assert I.Windows(1, 10_000).of(text)[1].tolist() == want
